"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from staypath.llm import queries, runs
from tests.conftest import SF_DIR

SCHEMA = "doc_id bigint, text string, runs string, h int, ws int, `a.b` double"


def by_hand(words, least=6, times=4):
    """Start, length and period of all runs."""
    got = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                got.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in got.items())


def kept(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words or doc_id is None:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def noisy(rng, most=8):
    out = []
    for _ in range(rng.randrange(most)):
        unit = [rng.choice("abcd"[:rng.choice([1, 2, 4])]) for _ in range(rng.randrange(1, 10))]
        out += unit * rng.randrange(1, 9) + [str(rng.randrange(40)) for _ in range(rng.randrange(4))]
    return out


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_several_texts_at_once(seed):
    rng = random.Random(seed)
    texts = [noisy(rng) for _ in range(6)]
    at = np.cumsum([0, *map(len, texts)])
    hashes = np.array([zlib.crc32(w.encode()) for t in texts for w in t], dtype=np.uint64)
    a, b, q = runs.runs(runs.dense(hashes, at), at) if len(hashes) else [np.array([])] * 3
    want = [(x + low, n, p) for low, t in zip(at, texts) for x, n, p in by_hand(t)]
    assert list(zip(a.tolist(), (b - a).tolist(), q.tolist())) == want


def test_a_rule_stands_for_equal_words_everywhere():
    rng = random.Random(5)
    at = np.array([0, 1000, 3000])
    words = runs.dense(np.array([rng.randrange(6) for _ in range(3000)], dtype=np.uint64), at)
    rule, start, border, end = runs.grammar(words, at)
    texts = {}
    for r, i, m, j in zip(*(c.tolist() for c in (rule, start, border, end))):
        assert i < m < j and (j <= 1000 or i >= 1000)
        assert texts.setdefault(r, (words[i:j].tolist(), m - i)) == (words[i:j].tolist(), m - i)
    assert len(texts) < len(rule) and max(end - start) == 2000


def test_odd_rows(spark):
    unit = [f"w{i}" for i in range(300)]
    rows = [
        (1, "a a a a a a"), (2, "a a a a a"), (3, None), (4, ""), (5, " \n\t\x0b"), (6, "A a A a A a A a"), (7, "x " * 20_000),
        (8, " ".join(unit * 4)), (9, " ".join(unit * 4)[:-2]), (9, "b b b b b b b"), (None, "c\nc  c\tc c c d"), (10, "ä ä ä ä ä ä é"),
        (10, "ä ä ä ä ä ä é"), (11, "a b " * 30 + "a a a a a a " + "a b " * 4),
    ]
    docs = spark.createDataFrame([(i, t, "r", 1, 2, 0.5) for i, t in rows], SCHEMA).repartition(3)
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()]
    want = []
    for i, t in rows:
        w = words_of(t)
        found = [(0, 20_000, 1)] if i == 7 else by_hand(w)
        want.append((i, len(w), found, kept(w, found)))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF_DIR).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        words = planted(i, words_of(text))
        found = by_hand(words)
        top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        want = (len(found), *(top[:3] if top else (None,) * 3), 1000 * top[1] // top[2] if top else None,
                hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
                hashlib.sha256(kept(words, found).encode()).hexdigest())
        assert tuple(got[i])[1:] == want
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def test_query_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a a a a a a", "r", 1, 2, .5), (3, None, "r", 1, 2, .5), (25, "", "r", 1, 2, .5)], SCHEMA)
    got = {r.doc_id: tuple(r)[1:6] for r in runs.run_digests(docs).collect()}
    assert got == {None: (1, 0, 6, 1, 6000), 3: (0,) + (None,) * 4, 25: (0,) + (None,) * 4}
    assert runs.run_digests(docs.limit(0)).count() == 0
