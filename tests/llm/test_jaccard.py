"""The n-gram Jaccard join on groups of texts close to the threshold."""

import random

import pytest

from staypath.llm import jaccard

SCHEMA = "doc_id bigint, text string, cls bigint, bits string, `a.b` double"


def sets_of(rows, size=5):
    out = {}
    for i, text in rows:
        words = (text or "").lower().split()
        out[i] = frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()
    return out


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def close_texts(n, seed, words=120, edits=(2, 6)):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(300)}" for _ in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randint(*edits)):
            own[rng.randrange(words)] = f"own{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(own)))
    return rows


def components_by_hand(rows):
    sets = sets_of(rows)
    at = {i: i for i, _ in rows}

    def top(i):
        while at[i] != i:
            i = at[i]
        return i
    ids = [i for i, _ in rows]
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if linked(sets[a], sets[b]):
                a_, b_ = top(a), top(b)
                at[max(a_, b_)] = min(a_, b_)
    return {i: top(i) for i in ids}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "b", 0.5) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("n", [200, 400])
def test_a_group_around_the_threshold(spark, n):
    rows = close_texts(n, n)
    got = {r.doc_id: r.component_id for r in jaccard.near_copies(frame(spark, rows)).collect()}
    assert got == components_by_hand(rows)


def test_bounds_leave_few_pairs_of_such_a_group(spark):
    made = {}
    for n in (200, 400):
        rows = frame(spark, close_texts(n, n))
        _, _, entries = jaccard._indexed(jaccard.documents(rows), 5, 80)
        entries = entries.where("l > 0")
        smaller = jaccard.F.struct("n_b", "b") < jaccard.F.struct("n_a", "a")
        frequent = entries.where("not rare")
        met = jaccard._side(frequent, "a").join(jaccard._side(frequent.where("inner"), "b"), "token").where(smaller & jaccard._possible(80, "common"))
        made[n] = met.count(), met.where(jaccard._bits_allow(80)).count(), entries.count()
    assert all(after <= before / 10 for before, after, _ in made.values()), made
    assert all(after <= rows for _, after, rows in made.values()), made


def test_class_links_are_all_links(spark):
    rows = close_texts(60, 3, edits=(1, 3)) + close_texts(30, 4, words=40, edits=(0, 2)) + [(200 + i, t) for i, t in close_texts(20, 3, edits=(0, 1))]
    rows = [(i, t) for i, (_, t) in enumerate(rows)] + [(900, None), (901, ""), (902, "two words"), (903, "Two  WORDS")]
    members, links = jaccard.class_links(frame(spark, rows))
    sets = sets_of(rows)
    cls = {r.doc_id: r.cls for r in members.collect()}
    want = {frozenset((cls[a], cls[b])) for a, x in sets.items() for b, y in sets.items() if a < b and x != y and linked(x, y)}
    got = [frozenset((r.a, r.b)) for r in links.collect()]
    assert set(got) == want and len(got) == len(want) > 100
    for r in members.collect():
        assert r.n_links == sum(r.cls in pair for pair in want) and (r.cls is None) == (not sets[r.doc_id])
    assert cls[902] == cls[903]


def test_texts_of_many_tokens(spark):
    """Bit tables of large sets are full, and must not rule out links."""
    rng = random.Random(9)
    base = [f"x{rng.randrange(10 ** 6)}" for _ in range(6000)]
    rows = []
    for i in range(8):
        own = list(base)
        for _ in range(60 * i):
            own[rng.randrange(len(own))] = f"y{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: r.component_id for r in jaccard.near_copies(frame(spark, rows)).collect()}
    assert got == components_by_hand(rows)
