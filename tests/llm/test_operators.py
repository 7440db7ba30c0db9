"""Corpus operators against brute force on small tables with odd rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from staypath.llm import (
    decontaminate, imatch, jaccard, lines, pieces, substrings, suffix_tree, toxicity, urls, warc, words,
)

SCHEMA = "doc_id bigint, text string, lang string, part int, keys string, score double"


def make(spark, rows):
    """Documents with columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", 1, "k", 0.5) for i, t in rows], SCHEMA)


def prose(seed, n, words_in_use=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words_in_use)}" for _ in range(n))


def odd_rows():
    base = prose(1, 200)
    cut = base.split()
    near = " ".join(cut[:100] + ["changed"] + cut[101:])
    far = " ".join(w if i % 7 else f"other{i}" for i, w in enumerate(cut))
    rows = [
        (1, base), (2, near), (3, base), (4, None), (5, ""), (6, "   \n\t"), (7, "One two"), (8, "one  TWO"), (9, "x" * 3000),
        (10, far), (11, base.upper()), (12, "é" * 40 + " ß 日本語"), (13, prose(2, 5000, 50)), (14, "a\nb\na\n" * 30),
        (None, base), (None, "no id"), (15, near), (15, near), (16, prose(3, 60)), (17, prose(3, 60) + " " + prose(4, 60)),
    ]
    return rows + [(100 + i, f"Shared line\nown line {i} {prose(50 + i, 20)}\n  shared LINE ") for i in range(12)]


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, odd_rows())


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, [])


def by_row(rows):
    return Counter(tuple(r) for r in rows)


def key_of(line):
    return line.encode().strip(b" \t\n\v\f\r").lower()


def test_words_are_split_and_folded_like_bytes():
    texts = [r[1] for r in odd_rows()]
    found, at = words.word_hashes(*words.joined([t.encode() if t else t for t in texts]))
    for t, a, b in zip(texts, at, at[1:]):
        plain = (t or "").encode().lower().split()
        assert len(plain) == b - a
        alone, _ = words.word_hashes(*words.joined([b" ".join(plain)]))
        assert (alone == found[a:b]).all()
    assert (words.unmix(words.mix(found)) == found).all()


def test_table_finds_its_keys_only():
    keys = words.mix(np.arange(1000, dtype=np.uint64))
    table = words.Table(keys)
    assert (table.find(keys) == np.arange(1000)).all()
    assert (table.find(words.mix(np.arange(1000, 2000, dtype=np.uint64))) == -1).all()
    assert (words.Table(keys[:0]).find(keys) == -1).all()


def test_line_dedup(docs):
    rows = [(i, t) for i, t in odd_rows()]
    seen = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen.setdefault(key_of(line), set()).add((i, t))
    hot = {k for k, own in seen.items() if k and len(own) >= 10}
    want = Counter()
    for i, t in rows:
        kept = [x for x in (t or "").split("\n") if key_of(x) not in hot]
        n = len((t or "").split("\n"))
        want[(i, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert by_row(lines.line_digests(docs).collect()) == want
    out = lines.drop_shared_lines(docs)
    assert out.schema.names == docs.schema.names and out.count() == docs.count()
    assert {r.text for r in out.where("doc_id = 4").collect()} == {None}
    bits = lines.keep_bitmaps(docs).collect()
    assert {(r.n_lines, r.n_dropped) for r in bits} == {(3, 2)} and len(bits) == 12


def test_line_dedup_across_partition_edges(spark):
    rows = [(i, "everywhere\nhere and there" if i % 3 else "everywhere") for i in range(300)]
    out = lines.line_digests(make(spark, rows).repartition(40), min_docs=150).collect()
    assert {r.n_dropped for r in out if r.doc_id % 3} == {2} and {r.n_dropped for r in out if r.doc_id % 3 == 0} == {1}


def shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def component_rows(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return Counter((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def test_near_copies_of_odd_rows(docs):
    assert by_row(jaccard.near_copies(docs).collect()) == component_rows(odd_rows())


def test_near_copies_of_a_large_group(spark):
    rng = random.Random(5)
    base = prose(9, 120).split()
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(30)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, prose(100 + i, 80)) for i in range(50)]
    assert by_row(jaccard.near_copies(make(spark, rows).repartition(7)).collect()) == component_rows(rows)


def test_one_document_of_each_group_stays(docs):
    out = jaccard.drop_near_copies(docs)
    assert out.schema.names == docs.schema.names
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert {1, 4, 5, 6, 7, 9, 10} <= set(ids) and not {2, 3, 8, 11, 15} & set(ids) and len(ids) == len(set(ids))


def removed_by_hand(rows):
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for row in order:
        data = (row[1] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            part = data[i:i + 100]
            if part in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[row] = (row[0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return Counter(out[r] for r in rows)


def test_repeated_bytes(spark):
    rows = [r for r in odd_rows() if r[0] is not None]
    rng = random.Random(3)
    shared = [prose(70 + i, 30) for i in range(4)]
    rows += [(200 + i, " ".join([prose(300 + i, rng.randrange(1, 40)), rng.choice(shared), prose(400 + i, 10), rng.choice(shared)[rng.randrange(60):]]))
             for i in range(60)]
    rows += [(300, "ab" * 400), (301, "b" + "ab" * 90), (302, "\0" * 250), (303, "\0" * 120)]
    assert by_row(substrings.remove_repeats(make(spark, rows).repartition(5)).collect()) == removed_by_hand(rows)


def test_repeats_across_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 500)
    rows = [(1, prose(11, 400)), (2, "x" + prose(11, 400)[300:1500] + "y"), (3, prose(12, 100))]
    assert by_row(substrings.remove_repeats(make(spark, rows)).collect()) == removed_by_hand(rows)


def test_own_repeats_of_a_long_text_in_different_pieces(spark):
    passage = prose(21, 60)
    data = random.Random(22).randbytes(substrings.PIECE // 2 + 200_000).hex()
    rows = [(1, passage + data + passage)]
    assert [r.n_removed for r in substrings.remove_repeats(make(spark, rows)).collect()] == [len(passage)]


def test_repeats_over_borders_of_small_pieces(spark):
    long = prose(11, 400)
    rows = [(1, long + prose(13, 200) + long[900:1400] + "z" * 700), (2, "x" + long[300:1500] + "y"), (3, prose(12, 100)), (4, prose(14, 20) + " " + prose(14, 20))]
    for piece in (250, 500, 733):
        assert by_row(substrings.remove_repeats(make(spark, rows), piece=piece).collect()) == removed_by_hand(rows)


def test_maximal_repeat_groups():
    a, b = "".join(random.Random(1).choices("abcd", k=140)), "".join(random.Random(2).choices("abcd", k=20))
    strings = [(b + a[10:]).encode(), (a + "z").encode(), a[:130].encode()]
    groups = {(n, tuple(sorted(zip(o.tolist(), p.tolist())))) for n, o, p in substrings.maximal_repeats(strings)}
    assert groups == {(120, ((0, 20), (1, 10), (2, 10))), (130, ((0, 20), (1, 10))), (130, ((1, 0), (2, 0)))}


def test_groups_list_every_occurrence(spark):
    rng = random.Random(3)
    passages = ["".join(rng.choices("abcdef ", k=n)) for n in (100, 130, 260, 480)]
    rows = []
    for i in range(40):
        text = "".join(rng.choices("ghij ", k=rng.randrange(60)))
        for p in rng.sample(passages, rng.randrange(4)):
            text += p[rng.choice([0, 0, 7]):] + "".join(rng.choices("ghij ", k=rng.randrange(1, 60)))
        rows.append((i, text))
    rows += [(50, rows[3][1]), (51, passages[1] * 2), (None, passages[2] + "x"), (52, None), (53, "short")]
    first = {}
    for i, t in rows:
        i = substrings.FIRST if i is None else i
        first[t] = min(first.get(t, i), i)
    texts = {i: t for t, i in first.items() if t}
    found = {}
    for r in substrings.repeat_groups(make(spark, rows).repartition(4)).collect():
        found.setdefault((r.group, r.length), set()).add((r.id, r.start))
    contents = {}
    for (group, length), places in found.items():
        own = {texts[i][a:a + length] for i, a in places}
        assert len(own) == 1 and length >= 100
        content = own.pop()
        assert places == {(i, a) for i, t in texts.items() for a in range(len(t) - length + 1) if t.startswith(content, a)} and len(places) > 1
        contents[content] = len(places)
    # every repeated window is in a group
    seen = Counter(t[a:a + 100] for t in texts.values() for a in range(len(t) - 99))
    for window, n in seen.items():
        assert n == 1 or any(window in c for c in contents), window


def test_fingerprints(docs):
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    out = imatch.fingerprints(docs).collect()
    assert len(out) == len(rows)
    unique = {r[0]: (r[1] or "") for r in rows if r[0] is not None}
    ids = sorted(unique)
    for r in out:
        if r.doc_id is not None and r.doc_id not in (15, 112 - 1):
            text, following = unique[r.doc_id], unique[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
            half = len(text) // 2
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1)
    same = {r.fingerprint for r in out if r.doc_id in (1, 3)}
    assert len(same) == 1 and {r.fingerprint for r in out if r.doc_id in (4, 5, 6)} == {"0" * 8 * imatch.SUBSETS}


def test_lexicon_counts_documents(spark):
    rows = [(i, f"common {'often ' * (i % 4 == 0)}rare{i}") for i in range(100)]
    found = imatch.lexicon(make(spark, rows), 0.02, 0.5).collect()
    assert [r.n_docs for r in found] == [25]


def test_sentencepiece_round_trips_and_matches_its_own_encoder(spark, docs):
    import sentencepiece
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    plain = {(r.doc_id, tuple(r.ids) if r.ids is not None else None) for r in pieces.encode(docs, rate=0.0).collect()}
    want = {(i, None if t is None else tuple(own.encode(t))) for i, t in odd_rows()}
    assert plain == want
    dropped = pieces.encode(docs, rate=0.3, seed=7)
    assert by_row(pieces.decode(dropped).collect()) == Counter(odd_rows())
    again = pieces.encode(docs.repartition(3), rate=0.3, seed=7)
    as_set = lambda df: {(r.doc_id, tuple(r.ids or ())) for r in df.collect()}
    assert as_set(dropped) == as_set(again) != as_set(pieces.encode(docs, rate=0.3, seed=8))
    assert all(r.lossless for r in pieces.round_trips(docs).collect())


@pytest.mark.parametrize("text", ["", " ", "  a ▁ b\n\t", "▁", "<0x0A> </s>", "\n" * 5, "x" * 20_000, "a\x00b\r\n", "\U0001F600" * 60])
def test_segmentation_is_lossless_and_the_same_with_a_heap(text):
    with open(pieces.MODEL, "rb") as file:
        made = pieces.Segmenter(file.read(), 0.2, 3)
    assert made.decode(made.encode(text, 5)) == text
    for chunk in pieces.CHUNK.findall(text[:40]):
        key = pieces.xxhash.xxh3_64_intdigest(b"3:1:" + chunk.encode())
        symbols = made.chars[np.frombuffer(chunk.encode("utf-32-le"), "<u4")].tolist()
        assert made._spelt(made._merged_heap(symbols, key)) == made.segment_many([chunk], 1)[0]


def test_each_occurrence_of_a_word_draws_its_own_skips():
    with open(pieces.MODEL, "rb") as file:
        made = pieces.Segmenter(file.read(), 0.1, 3)
    word = " international"
    keys = pieces.mix(np.arange(20_000, dtype=np.uint64))
    ids = made.segment_keyed([word] * len(keys), keys)
    symbols = made.chars[np.frombuffer(word.encode("utf-32-le"), "<u4")].tolist()
    for i in range(500):
        assert ids[i] == made._spelt(made._merged_heap(list(symbols), int(keys[i])))
    assert len(set(ids)) > 20
    whole = made.segment_keyed([" i"] * len(keys), keys)
    assert Counter(map(len, whole))[2] == pytest.approx(2000, abs=200)
    text = "international " * 3000
    rows = made.encode_many([text, text], [1, 2])
    assert rows[0] != rows[1] and made.decode(rows[0]) == text
    assert len(set(made.segment_keyed(["international"] * 3000, keys[:3000]))) > 4


def toxic_rows():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 8 == 0
        text = prose(i, rng.randrange(20, 90)).split()
        if toxic:
            text = [w if rng.random() > 0.1 else rng.choice(["vile", "nasty", "awful"]) + str(rng.randrange(4)) for w in text]
        rows.append((i, " ".join(text)))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_learns_from_confirmed_and_unlabelled(spark, docs, empty):
    rows, labels = toxic_rows()
    table = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(make(spark, rows), table).collect()}
    held = [i for i in out if out[i].held_out]
    assert set(held) == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([out[i].predicted == (i % 8 == 0) for i in held]) > 0.95
    assert all((r.score >= 0.5) == r.predicted and 0 <= r.score <= 1 for r in out.values())
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    kept = toxicity.drop_toxic(make(spark, rows), table)
    assert kept.schema.names == SCHEMA.replace(",", "").split()[::2] and kept.count() == sum(1 - r.predicted for r in out.values())


def test_toxicity_without_unlabelled_documents(spark):
    rows, _ = toxic_rows()
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r.predicted for r in toxicity.toxicity(make(spark, rows), labels).collect()}
    assert np.mean([out[i] == (i % 8 == 0) for i in out]) > 0.95
    assert toxicity.toxicity(make(spark, rows), labels.where("toxic = 0")).where("predicted = 1").count() == 0
    assert toxicity.drop_toxic(make(spark, []), labels).count() == 0


def test_slots_are_counted_over_all_texts(spark):
    rows, _ = toxic_rows()
    frame = spark.createDataFrame([(t, i % 2) for i, t in rows] + [(None, 0), ("", 1)], "text string, half int").repartition(5)
    counts, n = toxicity.frequencies(frame)
    import pyarrow as pa
    for h in (0, 1):
        assert (counts[h] == toxicity.presence(pa.array([t for i, t in rows if i % 2 == h], pa.string()))).all() and n[h] == 751


@pytest.mark.parametrize("stage", [
    lambda d: toxicity.drop_toxic(d, d.sparkSession.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")),
    lambda d: lines.drop_shared_lines(d), lambda d: jaccard.drop_near_copies(d),
    lambda d: decontaminate.drop_contaminated(d, d.sparkSession.createDataFrame([(1, "one two three four")], "item_id bigint, text string")),
])
def test_stages_keep_columns_of_any_name(spark, stage):
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("text", T.StringType()), ("a.b", T.DoubleType()), ("se`lect x", T.StructType([T.StructField("in ner", T.LongType())])))])
    rows = [(1, "some words of a text", 0.5, (1,)), (2, None, None, None), (None, "", 1.5, (2,))]
    docs = spark.createDataFrame(rows, schema)
    out = stage(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert stage(docs.limit(0)).count() == 0


def test_objects_are_shipped_by_value(spark, tmp_path):
    import pickletools
    from staypath.llm.frames import received, shipped
    sent = shipped(spark, suffix_tree.Words(np.arange(3, dtype=np.uint64), np.zeros(3), 5, 3))
    modules = {arg for op, arg, _ in pickletools.genops(sent.value) if op.name in ("SHORT_BINUNICODE", "BINUNICODE") and str(arg).startswith("staypath")}
    assert received(sent).total == 5
    # names may be carried along, but nothing is looked up in the package
    assert not [1 for op, arg, _ in pickletools.genops(sent.value) if op.name == "GLOBAL" and "staypath" in str(arg)], modules


def test_texts_without_a_term_of_the_lexicon_are_alike_only_if_equal(spark):
    rows = [(i, f"only{i} words{i} here{i}") for i in range(60)] + [(60, "only1 words1 here1"), (61, ""), (62, None)]
    out = {r.doc_id: r for r in imatch.fingerprints(make(spark, rows), 0.5, 0.9).collect()}
    assert out[1].fingerprint == out[60].fingerprint and len({out[i].fingerprint for i in range(60)}) == 60
    assert out[1].near_next == 0 and out[61].near_next == 1 and set(out[61].fingerprint) == {"0"}


def test_rules_need_more_than_a_few_urls(spark):
    labelled = spark.createDataFrame([(f"http://one{i}.org/p{i}", i % 4 == 0) for i in range(80)], "url string, block boolean")
    assert urls.mined_rules(labelled).where("verdict = 'block' and support < 0.05").count() == 0


def test_non_negative_risk_does_not_fall_below_zero_by_overfitting():
    rng = np.random.default_rng(0)
    p, u = rng.normal(2, 1, (60, 5)), np.r_[rng.normal(2, 1, (40, 5)), rng.normal(-2, 1, (360, 5))]
    w = toxicity.minimise(p, u, 0.1)
    z = np.c_[u, np.ones(len(u))] @ w
    assert (z[:40] > 0).mean() > 0.9 and (z[40:] < 0).mean() > 0.97


def test_url_rules(spark):
    pages = spark.createDataFrame([
        (1, "http://Example.COM/en/x?q=1"), (2, "https://www.example.com/en/7#a"), (3, "http://a.net/es/1"), (4, "http://a.net/ES/1"),
        (5, None), (6, "nothing"), (7, "ftp://com"), (8, "http://net/fr/"), (9, "http://xexample.com/en/"), (None, "http://a.org/1"), (1, "http://a.org/1"),
    ], "page_id bigint, url string")
    labelled = spark.createDataFrame(
        [(f"http://spam.org/win/{i}", True) for i in range(40)] + [(f"http://good{i % 7}.org/read/{i}", False) for i in range(60)] + [(None, True), ("x", None)],
        "url string, block boolean")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.url_verdicts(pages, labelled).collect()}
    assert got == {
        (1, "example.com", "/en/x", "example.com/en/", "block"), (2, "www.example.com", "/en/7", "www.example.com/en/", "allow"),
        (3, "a.net", "/es/1", "net/es/", "block"), (4, "a.net", "/ES/1", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
        (7, "com", "", None, "allow"), (8, "net", "/fr/", "net/fr/", "block"), (9, "xexample.com", "/en/", "com/", "allow"),
        (None, "a.org", "/1", None, "allow"), (1, "a.org", "/1", None, "allow")}
    rules = urls.mined_rules(labelled, 0.1, 0.9).collect()
    assert (["path:win"], "block") in [(r.rule_tokens, r.verdict) for r in rules]
    again = urls.url_verdicts(spark.createDataFrame([(1, "http://new.org/win/3"), (2, "http://new.org/read/3")], "page_id bigint, url string"), labelled, min_support=0.1)
    assert {(r.page_id, r.verdict) for r in again.collect()} == {(1, "block"), (2, "allow")}
    none = spark.createDataFrame([], "url string, block boolean")
    assert urls.url_verdicts(pages, none, rules=()).where("verdict <> 'allow'").count() == 0


def test_warc_round_trip(spark, tmp_path):
    long = "<p>" + "x" * 1200
    rows = [(1, "http://a/1", long), (2, "http://a/2\r\nEvil: 1", long), (3, None, long), (4, "http://a/4", None), (5, "http://a/5", ""), (6, "u", "short"),
            (7, "u", "short"), (None, "http://n", long), (8, "http://é/ü", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" + "é" * 900), (8, "again", "é" * 600)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    index = warc.write_archives(pages, f"{tmp_path}/archive")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
                  for r in warc.read_records(index).collect())
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = html == long and page != 3
        want[(page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, None if revisit else data)] += 1
    assert got == want
    some = warc.read_records(index.where("page_id in (1, 8)"))
    assert sorted(r.page_id for r in some.collect()) == [1, 8, 8]
    assert {r.url for r in some.collect() if r.page_id == 1} == {"http://a/1"}


def test_ranges_are_coalesced():
    rows = [("f", 0, 10), ("f", 10, 5), ("f", 20 + warc.GAP, 5), ("g", 0, 1)]
    assert [(f, a, b, len(r)) for f, a, b, r in warc.ranges(rows)] == [("f", 0, 15, 2), ("f", 20 + warc.GAP, 25 + warc.GAP, 1), ("g", 0, 1, 1)]


def test_decontamination_finds_copies_and_paraphrases(spark, docs, empty):
    items = [(i, prose(900 + i, 14 + i, 5000)) for i in range(40)]
    rng = random.Random(8)
    rows, want = [], {}
    for n in range(200):
        text = prose(5000 + n, 150, 3000).split()
        if n % 4 == 0:
            item, passage = n % 40, items[n % 40][1].split()
            if n % 8 == 0:
                for _ in range(len(passage) // 8):
                    passage[rng.randrange(len(passage))] = "swapped"
            text[60:60] = ["Intro:", *passage[:-1], passage[-1].upper() + "."]
            want[n] = item
        rows.append((n, " ".join(text)))
    benchmark = spark.createDataFrame(items + [(None, "none"), (99, ""), (98, None)], "item_id bigint, text string")
    out = {r.doc_id: r for r in decontaminate.contaminated(make(spark, rows), benchmark).collect()}
    assert {n for n in out if out[n].contaminated and n not in want} == set()
    assert {n for n in want if n % 8 and want[n] not in out[n].item_ids} == set()
    assert sum(want[n] in out[n].item_ids for n in want) >= 0.9 * len(want)
    kept = decontaminate.drop_contaminated(make(spark, rows), benchmark)
    assert kept.schema.names == SCHEMA.replace(",", "").split()[::2] and kept.count() == sum(not r.contaminated for r in out.values())
    in_blocks = decontaminate.with_items(make(spark, rows), benchmark, block=15)
    assert {r.row.doc_id: r._items for r in in_blocks.collect() if r._items}.keys() >= {n for n in want if n % 8}
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r.contaminated for r in decontaminate.contaminated(docs, none).collect())


def test_candidate_search_recalls_what_brute_force_finds(spark):
    items = [(i, prose(900 + i, 30, 5000)) for i in range(60)]
    rows = [(n, prose(n, 100, 3000) + " " + items[n % 60][1] + " " + prose(n + 500, 100, 3000)) for n in range(120)]
    ids, own = decontaminate.item_block([T.Row(item_id=i, text=t) for i, t in items])
    space = decontaminate.latent_space(make(spark, rows).select("text"), ids, own)
    judge = decontaminate.Judge(space)
    data, starts = words.joined([t.encode() for _, t in rows])
    found = decontaminate.found_items(space, judge, data, starts)
    sequence, at = decontaminate.plain_words(data, starts)
    brute = [{i for i in range(60) if judge.holds(i, sequence[a:b].tolist())} for a, b in zip(at, at[1:])]
    hit = sum(len(b & set(f)) for b, f in zip(brute, found))
    assert hit >= 0.9 * sum(map(len, brute)) and sum(map(len, brute)) >= 120


def found_and_brute(spark, items, rows):
    ids, own = decontaminate.item_block([T.Row(item_id=i, text=t) for i, t in items])
    space = decontaminate.latent_space(make(spark, rows).select("text"), ids, own)
    judge = decontaminate.Judge(space)
    data, starts = words.joined([t.encode() for _, t in rows])
    found = decontaminate.found_items(space, judge, data, starts)
    sequence, at = decontaminate.plain_words(data, starts)
    brute = [sorted(ids[i] for i in range(len(ids)) if judge.holds(i, sequence[a:b].tolist())) for a, b in zip(at, at[1:])]
    return [sorted(f) for f in found], brute


def test_a_full_block_hides_no_item(spark):
    rng = random.Random(6)
    rows = [(n, prose(n, 150, 3000)) for n in range(100)]
    items = [(i, prose(900 + i, 20, 5000)) for i in range(50)]
    for n, (_, text) in enumerate(items):
        passage = text.split()
        for k in rng.sample(range(20), 6):
            passage[k] = f"w{rng.randrange(3000)}"
        cut = rows[n][1].split()
        rows[n] = (n, " ".join(cut[:70] + passage + cut[70:]))
    others = [t.split() for _, t in rows]
    items += [(1000 + i, " ".join(others[i % 100][k:k + 30])) for i in range(1500) for k in [rng.randrange(100)]]
    found, brute = found_and_brute(spark, items, rows)
    assert found == brute and sum(map(len, brute)) >= 1500


def test_items_of_any_length_are_found(spark):
    items = [(1, prose(1, 900, 5000)), (2, "single"), (3, "two words"), (4, prose(4, 64, 5000)), (5, "same same same same")]
    rows = [(n, prose(50 + n, 300, 3000)) for n in range(20)]
    for n, (_, text) in enumerate(items):
        cut = rows[n][1].split()
        rows[n] = (n, " ".join(cut[:130] + [text] + cut[130:]))
    found, brute = found_and_brute(spark, items, rows)
    assert found[:5] == brute[:5] == [[1], [2], [3], [4], [5]] and found == brute


def test_common_length_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(50):
        a, b = [rng.randrange(6) for _ in range(20)], [rng.randrange(6) for _ in range(30)]
        grid = [[0] * 31 for _ in range(21)]
        for i in range(20):
            for j in range(30):
                grid[i + 1][j + 1] = grid[i][j] + 1 if a[i] == b[j] else max(grid[i][j + 1], grid[i + 1][j])
        bits = {}
        for i, w in enumerate(a):
            bits[w] = bits.get(w, 0) | 1 << i
        assert decontaminate.common_length(bits, 20, b) == grid[20][30]


def test_language_model(spark, docs):
    rows = odd_rows() + [(2000 + i, "the cat sat on the mat and the dog sat on the cat " * 3) for i in range(30)]
    table = make(spark, rows).repartition(4)
    counts, want = Counter(), []
    for i, t in rows:
        tokens = (t or "").encode().lower().split() + [b"\n"]
        held = zlib.crc32(str(i).encode() if i is not None else b"") % 10 == 0
        want.append((i, held, tokens))
    for _, held, tokens in want:
        counts.update(() if held else tokens)
    total, distinct = sum(counts.values()), len(counts)
    base = lambda tokens: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
    expected = sorted((str(i), held, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base(tokens), 6)) for i, held, tokens in want)
    out = suffix_tree.text_scores(table).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == expected
    fluent = [r for r in out if r.doc_id is not None and r.doc_id >= 2000]
    assert all(r.score > r.base_score for r in fluent)


def scores_by_hand(rows, depth=3, least=8, divergence=32.0):
    """The suffix tree from its definition, word by word."""
    texts = [((t or "").encode().lower().split() + [b"\n"], zlib.crc32(str(i).encode()) % 10 == 0) for i, t in rows]
    n = Counter()
    for tokens, held in texts:
        if not held:
            for k in range(1, depth + 2):
                n.update(tuple(tokens[i:i + k]) for i in range(len(tokens) - k + 1))
    total, distinct = sum(c for s, c in n.items() if len(s) == 1), sum(len(s) == 1 for s in n)
    root = lambda w: (n[w,] + 0.1) / (total + 0.1 * (distinct + 1))
    after = {}
    for s, c in n.items():
        if len(s) > 1 and c >= least:
            after.setdefault(s[:-1], {})[s[-1]] = c
    states = set(after)

    def left(context):
        return max(1 - sum(c - 0.5 for c in after[context].values()) / n[context], 1e-12)

    def chance(context, w):
        while context and context not in states:
            context = context[1:]
        if not context:
            return root(w)
        c = after[context].get(w)
        return left(context) * chance(context[1:], w) + ((c - 0.5) / n[context] if c else 0)
    kept = set()
    for context, words_ in after.items():
        saved = sum(c * math.log2(chance(context, w) / chance(context[1:], w)) for w, c in words_.items())
        saved += (n[context] - sum(words_.values())) * math.log2(left(context))
        if saved >= divergence:
            kept |= {context[k:] for k in range(len(context))}
    states = kept & set(after)
    return [sum(math.log10(chance(tuple(tokens[max(0, i - depth):i]), w)) for i, w in enumerate(tokens)) for tokens, _ in texts], len(states)


@pytest.mark.parametrize("group", [1 << 21, 40])
def test_scores_equal_the_definition(spark, group):
    rng = random.Random(8)
    units = ["the cat sat on the mat", "on the other hand", "w1 w2 w3 w4 w5", "a b", "x", "y y y"]
    rows = [(i, " ".join(rng.choice(units) for _ in range(rng.randrange(40)))) for i in range(150)] + [(900, None), (901, "never seen before the cat")]
    want, many = scores_by_hand(rows)
    assert many > 20
    got = {r.doc_id: r.score for r in suffix_tree.text_scores(make(spark, rows).repartition(3), group=group).collect()}
    assert [got[i] for i, _ in rows] == pytest.approx(want, abs=1e-6)


def test_next_word_distributions_sum_to_one(spark):
    rows = [(i, prose(i, 60, 12)) for i in range(200)]
    table = make(spark, rows).withColumn("held_out", suffix_tree.held_out())
    model = suffix_tree.learn(table, depth=2, divergence=0.0)
    states = model.group(0)
    names = sorted({w for _, t in rows for w in t.split()})
    every, _ = words.word_hashes(*words.joined([" ".join(names).encode()]))
    assert all(len(rest) for _, rest, _, _ in states.levels)
    for context in (["w1", "w2"], ["w3"], ["w5", "w5"], []):
        own, _ = words.word_hashes(*words.joined([" ".join(context).encode()]))
        total = 0.0
        for word in [*every, suffix_tree.END, np.uint64(12345)]:
            sequence = np.append(own, word).astype(np.uint64)
            known, _, score = suffix_tree.token_scores(model.tree, states, sequence, np.array([0, len(sequence)]))
            assert known[-1] == (word != 12345)
            total += 10 ** score[-1] * (1 if known[-1] else 0.1 / model.tree.space)
        assert total == pytest.approx(1.0, abs=1e-6)


@pytest.mark.parametrize("run", [
    lines.line_digests, jaccard.near_copies, substrings.remove_repeats, imatch.fingerprints, pieces.round_trips, suffix_tree.text_scores,
])
def test_empty_tables_give_no_rows(empty, run):
    assert run(empty).count() == 0


def test_empty_tables_of_two_table_operators(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    pages = spark.createDataFrame([(1, "http://a.org/1", "<p>x")], "page_id bigint, url string, html string")
    assert toxicity.toxicity(empty, labels).count() == 0 and toxicity.toxicity(docs, labels.limit(0)).count() == docs.count()
    assert decontaminate.contaminated(empty, items).count() == 0
    assert urls.url_verdicts(pages.limit(0), urls.labelled_urls(pages, labels)).count() == 0
    assert urls.url_verdicts(pages, urls.labelled_urls(pages, labels.limit(0))).count() == 1
    index = warc.write_archives(pages.limit(0))
    assert index.count() == 0 and warc.read_records(index).count() == 0


def test_only_unusable_rows(spark):
    rows = make(spark, [(None, None), (None, None), (1, None), (2, "")])
    assert {r.n_dropped for r in lines.line_digests(rows).collect()} == {0}
    assert by_row(jaccard.near_copies(rows).collect()) == Counter({(None, 0, None): 2, (1, 0, 1): 1, (2, 0, 2): 1})
    assert {r.n_removed for r in substrings.remove_repeats(rows).collect()} == {0}
    assert imatch.fingerprints(rows).count() == 4
    assert suffix_tree.text_scores(rows).count() == 4


def test_learn_leaves_only_the_fitted_parts_staged(spark):
    from staypath.sources.tables import _staging
    rows = [(i, prose(i, 60, 12)) for i in range(200)]
    table = make(spark, rows).withColumn("held_out", suffix_tree.held_out())
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging(spark))
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = lambda: {s.getPath().getName() for s in system.listStatus(folder)} if system.exists(folder) else set()
    before = listed()
    model = suffix_tree.learn(table, depth=2, divergence=0.0)
    kept = {name.rsplit("/", 2)[-2] for name in model.fitted.inputFiles()}
    assert listed() - before == kept
    assert model.group(0).levels


def test_sequence_blocks_send_what_is_held_after_each_chunk(monkeypatch):
    import types
    import pyarrow as pa
    from staypath.llm.phrases import BITS
    monkeypatch.setattr(suffix_tree, "HELD_SEQUENCES", 1)
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(1500)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    chunked = [len(starts) - 1 for _, _, starts in words.chunks(batch.column("text"))]
    assert len(chunked) > 1
    shared = types.SimpleNamespace(value=np.full(1 << (BITS - 3), 255, dtype=np.uint8))
    sent = list(suffix_tree._sequence_blocks(3, shared, 16)([batch]))
    held = [sum(len(w) for w in b.column("words").to_pylist()) // 24 for b in sent]
    assert sum(held) == sum(1500 - 1 for _ in texts)
    assert max(held) <= max(chunked) * (1500 - 1)
