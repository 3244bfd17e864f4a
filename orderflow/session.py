"""Session settings the library relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app_name: str = "orderflow", master: str | None = None, **conf: str) -> SparkSession:
    """Builds (or returns) a session with UTC time and adaptive execution on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Streaming jobs checkpoint small frames in every micro-batch; drop them once unused.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Plans here have many columns; recording the Python call site of each one is not needed.
        "spark.sql.dataFrameQueryContext.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All day boundaries and timestamp texts are UTC; a session made elsewhere may not be."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_small_methods(spark: SparkSession) -> SparkSession:
    """HotSpot never compiles a method of more than 8000 bytes; Spark then makes smaller ones of the wide expressions here."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it (tests); there a temporary folder is set, once.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="orderflow-"))
    return sc.getCheckpointDir()


def frozen(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and fixes values that must not change on a re-run."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back.

    For a frame that feeds several outputs: each of them then scans only the columns (and, with
    ``partition_by``, only the partitions) it needs instead of repeating the work above.
    """
    path = f"{shared_dir(df.sparkSession)}/staged/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(_moved_last(df, partition_by)).parquet(path)


def _moved_last(df: DataFrame, column: str | None):
    schema = df.schema
    if column is None:
        return schema
    from pyspark.sql.types import StructType

    return StructType([f for f in schema if f.name != column] + [schema[column]])
