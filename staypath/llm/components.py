"""Connected components of an edge table, by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from staypath.llm.frames import discard, forget, staged


#: edges of a file
EDGES = 500_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (``large``) or smaller neighbours, and in the latter case itself, to the least of all."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    joined = both.join(least, "a")
    if large:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    return made.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) of every node of ``a, b`` edges; each round is written to the shared folder.

    A node with very many edges is summed up in map-side minima and joined as one skewed key, never collected.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    known, files = None, 1 + edges.count() // EDGES
    while True:
        # stars do not add edges beyond one a node; few of them need few files
        before, edges = edges, staged(_star(_star(edges, True), False).coalesce(files))
        discard(before)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    forget(edges.sparkSession)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
