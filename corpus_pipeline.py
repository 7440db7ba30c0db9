"""Training-data pipeline: each stage works on what the one before kept.

Null and empty texts, rows without id, repeated rows and columns of any name go through all stages; only ``ngram_jaccard``
keeps one of several equal rows. An empty table stays one. The last stage gives null texts null ids.
"""

from pyspark.sql import DataFrame, SparkSession

from staypath.llm.decontaminate import drop_contaminated
from staypath.llm.frames import read, session, staged
from staypath.llm.jaccard import drop_near_copies
from staypath.llm.lines import drop_shared_lines
from staypath.llm.pieces import round_trips
from staypath.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents predicted to be toxic."""
    session(spark)
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that ten or more documents share out of the texts."""
    session(spark)
    return drop_shared_lines(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    session(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark item."""
    session(spark)
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it."""
    session(spark)
    return round_trips(docs, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

#: the first stage's classifier has no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
