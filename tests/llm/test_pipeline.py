"""Every stage of the pipeline against a brute-force version on the stage's own input."""

import re
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from staypath.llm import decontaminate, pieces, toxicity, words
from staypath.sources.tables import staged
from tests.conftest import SF_DIR
from tests.llm.test_jaccard import components_by_hand, sets_of


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def without_shared_lines(docs):
    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
    held = Counter()
    for text in docs.values():
        held.update({key(line) for line in (text or "").split("\n")})
    gone = {k for k, n in held.items() if n >= 10 and k}
    return {i: t if t is None else "\n".join(line for line in t.split("\n") if key(line) not in gone) for i, t in docs.items()}


def one_of_each_group(docs):
    sets = sets_of(docs.items())
    group = components_by_hand(sorted(docs.items()))
    return {i: t for i, t in docs.items() if group[i] == i or not sets[i]}


def without_items(spark, docs, df):
    ids, own = decontaminate.item_block(spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").collect())
    judge = decontaminate.Judge(decontaminate.latent_space(df.select("text"), ids, own))
    sequence, at = decontaminate.plain_words(*words.joined([(t or "").encode() for t in docs.values()]))
    holds = [any(judge.holds(i, sequence[a:b].tolist()) for i in range(len(ids))) for a, b in zip(at, at[1:])]
    return {i: t for (i, t), hit in zip(docs.items(), holds) if not hit}


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = staged(stage(spark, docs, SF_DIR))
        out[name], docs = (docs, made), made
    return out


def test_stages_follow_one_another(stages):
    assert list(stages) == ["toxicity", "line_dedup", "ngram_jaccard", "decontamination", "pieces"]
    for name, (before, after) in stages.items():
        assert name == "pieces" or after.columns == before.columns


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    rejected = {r.doc_id for r in toxicity.toxicity(before, spark.read.parquet(f"{SF_DIR}/labels.parquet")).where("predicted = 1").collect()}
    assert texts(after) == {i: t for i, t in texts(before).items() if i not in rejected} and rejected


def test_line_dedup(stages):
    before, after = map(texts, stages["line_dedup"])
    assert after == without_shared_lines(before) != before


def test_ngram_jaccard(stages):
    before, after = map(texts, stages["ngram_jaccard"])
    assert after == one_of_each_group(before) and len(after) < len(before)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    assert texts(after) == without_items(spark, texts(before), before) != texts(before)


def test_pieces(stages):
    before, after = stages["pieces"]
    own, docs = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), texts(before)
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(docs) and all(r.lossless for r in rows)
    for r in rows:
        assert len(r.ids) == r.n_pieces >= len(own.encode(docs[r.doc_id]))
    plain = {r.doc_id: r.ids for r in pieces.encode(before, rate=0.0).collect()}
    assert plain == {i: own.encode(t) for i, t in docs.items()}


def test_run_is_all_stages(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(str, stages["pieces"][1].collect()))
