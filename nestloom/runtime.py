"""Session defaults, table loading and durable intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
_FOLDERS: set[str] = set()


def build_session(app: str = "nestloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a session on one machine may do without that setting; it takes a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    fallback = os.path.join(tempfile.gettempdir(), f"nestloom-{spark.sparkContext.applicationId}")
    spark.conf.set(CHECKPOINT_KEY, f"file://{fallback}")
    return f"file://{fallback}"


def allow_repeated_keys() -> None:
    """Let JSON objects with repeated keys be parsed, by their last values; without this such a record is lost."""
    SparkSession.active().conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def materialize(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder, in one folder for each value of the columns ``by``, and read it back.

    This cuts the lineage, survives the loss of executors, and later reads prune columns.  The
    tables of an application are removed when its driver ends, or by ``clean_up``.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path, partitionBy=list(by) or None)
    return spark.read.schema(df.schema).parquet(path)


def _own_folder(spark: SparkSession) -> str:
    folder = f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove_quietly, spark, folder)
    return folder


def clean_up(spark: SparkSession) -> None:
    """Remove the tables that ``materialize`` wrote in this application; results that are still unread need them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _remove_quietly(spark: SparkSession, folder: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001, S110 - the session may be gone already
        pass


def is_empty(df: DataFrame) -> bool:
    return not df.head(1)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def looked_up(facts: DataFrame, lookup: DataFrame, keys: list[str], share: int = 1_000, least: int = 1_000_000) -> DataFrame:
    """``facts`` joined with ``lookup``, which has each key once, without a task that gets all rows of a frequent key.

    Keys with over 1/share of all facts are fewer than ``share``: only their rows of ``lookup``
    are broadcast.  All others are shuffled.  Fewer than ``least`` facts are simply joined.
    """
    n = facts.count()
    if n < least:
        return facts.join(lookup, keys)
    heavy = facts.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") * share > n).select(*keys)
    heavy = heavy.sparkSession.createDataFrame(heavy.collect(), heavy.schema)
    few = facts.join(F.broadcast(lookup.join(F.broadcast(heavy), keys)), keys)
    return few.unionByName(facts.join(F.broadcast(heavy), keys, "left_anti").join(lookup, keys))


def spread_key(buckets: int, *cols: Column) -> Column:
    """A salt in [0, buckets) that depends only on the row, so that retries agree."""
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")
