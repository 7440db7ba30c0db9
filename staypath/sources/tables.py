"""Readers and writers for the event log and for feature tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from staypath.schema import EVENT_SCHEMA


REJECTED = "_rejected"


def read_event_log(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """JSON event log with a declared schema, so no pass over the files is spent on inference.

    Lines that do not fit become rows with nulls; :func:`read_checked_log` keeps them apart.
    """
    return spark.read.schema(schema).json(path)


def read_checked_log(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """Events of a JSON log, and the lines that are none: ``file, reason, line``.

    ``reason`` is ``broken`` for text that is no JSON object, a cut-off line for example, and ``type`` for an object with a
    field of another type. Every line, blank ones aside, is in exactly one of the two tables. All fields are checked
    whichever columns are read, since whole lines are parsed against the whole schema.
    """
    checked = T.StructType([*schema, T.StructField(REJECTED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    lines = spark.read.text(path).where("trim(value) <> ''").select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"), F.from_json("value", checked, options).alias("event"))
    fits = F.col(f"event.{REJECTED}").isNull() & F.expr("json_object_keys(line) is not null")
    reason = F.expr("if(json_object_keys(line) is null, 'broken', 'type')").alias("reason")
    return (
        lines.where(fits).select(*[F.col(f"event.`{f.name}`") for f in schema]),
        lines.where(~fits).select("file", reason, "line"),
    )


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Rejected lines as Parquet, by reason; appended, so each load adds its own."""
    rejects.write.mode("append").partitionBy("reason").parquet(path)


def write_event_log(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature table or training set in Parquet."""
    return spark.read.parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_features_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Feature table in CSV with a header line; the schema is given, not inferred.

    Nothing between two commas is null, a quoted empty text stays an empty text: the null marker
    is moved to a character that no field holds.
    """
    return spark.read.schema(schema).csv(path, header=True, nullValue="\0")


def write_features_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with header. With ``files`` the table is written by all tasks, and its parts are then joined into that many files.

    The parts are joined as bytes by the file system's own API, so the computation keeps its parallelism.
    """
    if files is None:
        df.write.mode("overwrite").csv(path, header=True)
        return
    apart = f"{path.rstrip('/')}-parts-{uuid.uuid4().hex}"
    df.write.csv(apart, header=True)
    join_csv(df.sparkSession, apart, path, files)


def join_csv(spark: SparkSession, source: str, target: str, files: int) -> None:
    """Move the rows of a folder's CSV files, which all have the same header line, into ``files`` files of about equal size."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder, goal = hadoop.fs.Path(source), hadoop.fs.Path(target)
    system = folder.getFileSystem(conf)
    system.delete(goal, True)
    system.mkdirs(goal)
    parts = sorted((s.getPath().getName(), s.getLen()) for s in system.listStatus(folder) if s.getPath().getName().startswith("part-"))
    total, upto, out, written = sum(n for _, n in parts), 0, None, 0
    for name, n in parts:
        if out is None or (written < files and upto * files >= total * written):
            if out is not None:
                out.close()
            out = system.create(hadoop.fs.Path(goal, f"part-{written:05d}.csv"), True)
            written, first = written + 1, True
        part = system.open(hadoop.fs.Path(folder, name))
        header = part.readLine()
        if first and header is not None:
            part.seek(0)
        first = first and header is None
        hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
        part.close()
        upto += n
    if out is not None:
        out.close()
    system.create(hadoop.fs.Path(goal, "_SUCCESS"), True).close()
    system.delete(folder, True)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` or the context's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def _staging(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For tables that several jobs read: the work is done once, lineage ends at files that survive a
    lost executor, and later readers prune columns. :func:`clear_staged` removes them.
    """
    spark = df.sparkSession
    path = f"{_staging(spark)}/{uuid.uuid4().hex}"
    write_features(df, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove staged tables whose readers have all been written; anything else is left alone."""
    for df in tables:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            if path.toUri().getPath().startswith(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging(spark)).toUri().getPath()):
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_staged(spark: SparkSession) -> None:
    """Remove all tables that this application has staged; call it when its results are written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
