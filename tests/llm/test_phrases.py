"""Phrase mining against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from staypath.llm import phrases
from staypath.llm.words import mix

SCHEMA = "doc_id bigint, text string, lang string, key string, f int, words int, `a.b` double"


def by_hand(rows, least, top, longest=4, covered=80):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {(lang, p): c for (lang, p), c in f.items() if len(p) > 1 and c >= least}
    gone = set()
    for (lang, p), c in candidates.items():
        for a in range(len(p)):
            for b in range(a + 2, len(p) + 1):
                if b - a < len(p) and 100 * c >= covered * f[lang, p[a:b]]:
                    gone.add((lang, p[a:b]))
    out = {}
    for (lang, p), a in candidates.items():
        if (lang, p) not in gone:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def corpus(seed, n=60):
    rng = random.Random(seed)
    units = ["New York", "in the long run", "a b a b", "x", "y z", "état de grâce", "the", "of the", "日本 語", "q"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(units) + rng.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "!", " "]) for _ in range(rng.randrange(40)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None, ""])))
    return rows + [(900, None, "en"), (901, "", None), (902, " ,;. ", "fr"), (5, rows[5][1], "en"), (5, rows[5][1], "en"), (None, "the " * 5000, "en")]


@pytest.mark.parametrize("seed, least, top, trie", [(1, 3, 2000, 1 << 21), (2, 10, 3, 20), (3, 2, 2000, 7), (4, 100, 2000, 1 << 21)])
def test_phrases_equal_brute_force(spark, seed, least, top, trie):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, lang, "k", 1, 2, 0.5) for i, t, lang in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in phrases.collocations(docs, least, top, trie=trie).collect()]
    assert sorted(got) == by_hand(rows, least, top)


def test_tables_without_phrases(spark):
    docs = spark.createDataFrame([(1, None, None, "k", 1, 2, .5), (2, "one two", "en", "k", 1, 2, .5)], SCHEMA)
    for frame in (docs, docs.limit(0)):
        found = phrases.collocations(frame)
        assert found.count() == 0 and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("words, many", [(50, 400), (3000, 5000)])
def test_double_array_knows_its_phrases_only(words, many):
    rng = np.random.default_rng(3)
    ids = mix(np.arange(words, dtype=np.uint64))
    pairs = np.unique(np.minimum(rng.zipf(1.3, (many, 2)), words) - 1, axis=0)
    triples = np.unique(np.concatenate([pairs[rng.integers(0, len(pairs), many)], rng.integers(0, words, (many, 1))], axis=1), axis=0)
    trie = phrases.Trie([ids[pairs], ids[triples]])
    table, radix, base, check, state, _ = trie.frozen([np.arange(len(pairs)), np.arange(len(triples))])
    numbers = {int(w): i + 1 for i, w in enumerate(table)}
    states = [s for level in trie.states for s in level.tolist()]
    assert len(set(states)) == len(pairs) + len(triples) == len(state)
    assert len(check) < words + 12 * (len(pairs) + len(triples)) + 100 * radix

    def walk(phrase):
        at = numbers.get(int(ids[phrase[0]]), 0)
        for w in phrase[1:]:
            w = numbers.get(int(ids[w]), 0)
            for digit in (w // radix, w % radix):
                at = base[at] + digit if at and w and base[at] >= 0 and base[at] + digit < len(check) and check[base[at] + digit] == at else 0
        return at
    known = {tuple(p) for p in pairs.tolist()}
    for p, s in zip(pairs.tolist(), trie.states[0].tolist()):
        assert walk(p) == s
    for p, s in zip(triples.tolist(), trie.states[1].tolist()):
        assert walk(p) == s
    for p in rng.integers(0, words, (2000, 2)).tolist():
        assert (walk(p) > 0) == (tuple(p) in known)
