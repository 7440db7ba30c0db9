"""Dictionary of a long categorical column, and rows as sparse vectors over it; neither passes through the driver."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window, functions as F, types as T

from staypath.sources.tables import staged


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """``<column>, position, n``: each non-null value, its place in sorted order from 0 and its rows.

    Values are cut into sorted ranges, one a task. A value's place is its place in its range plus the number of values in
    the ranges before, of which there is one row a range. The ranges are stored first, so a task that runs again cannot
    see other cuts.
    """
    spark = df.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = df.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").alias(column)).agg(F.count("*").alias("n"))
    ranged = staged(counts.repartitionByRange(ranges, f"`{column}`").withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count("*").alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(f"`{column}`")) - 1
    return ranged.join(F.broadcast(starts), "_part").select(f"`{column}`", (F.col("_start") + inside).alias("position"), "n")


def sparse_rows(df: DataFrame, column: str, known: DataFrame, key: str = "userId") -> DataFrame:
    """``key, size, indices, values``: how often a key has each value of ``known``, as one sparse vector a key.

    ``known`` is a :func:`dictionary`; values it does not hold are left out, and so are keys without any other. ``df`` is
    summed per (key, value) before it meets the dictionary, which Spark broadcasts if it is small and otherwise joins by
    value, splitting a value that very many keys have.
    """
    held = df.where(F.col(f"`{column}`").isNotNull()).groupBy(key, f"`{column}`").agg(F.count("*").alias("times"))
    size = known.agg(F.coalesce(F.max("position") + 1, F.lit(0))).scalar()
    rows = held.join(known.select(f"`{column}`", "position"), column).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col("position").cast("int").alias("i"), F.col("times").cast("double").alias("v")))).alias("at"))
    return rows.select(key, size.cast("int").alias("size"), F.col("at.i").alias("indices"), F.col("at.v").alias("values"))


def as_vectors(rows: DataFrame, name: str = "features", key: str = "userId") -> DataFrame:
    """:func:`sparse_rows` with an MLlib vector column, for ``VectorAssembler`` and the classifiers.

    A sparse vector is stored as the same fields, so the rows are written once and read back as vectors.
    """
    spark = rows.sparkSession
    fields = F.struct(F.lit(0).cast("tinyint").alias("type"), "size", "indices", "values").alias(name)
    stored = staged(rows.select(key, fields))
    schema = T.StructType([rows.schema[key], T.StructField(name, VectorUDT())])
    return spark.read.schema(schema).parquet(*stored.inputFiles()) if stored.inputFiles() else spark.createDataFrame([], schema)
