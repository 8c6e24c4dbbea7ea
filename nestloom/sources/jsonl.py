"""JSON Lines as one variant per record, with the file each came from."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nestloom.functions.naming import source_key_column
from nestloom.runtime import allow_repeated_keys
from nestloom.sources import files


def entities(root: str) -> list[str]:
    """Folders with at least one ``*.gz`` below them, those with the fewest files first; hidden and underscored ones are none."""
    found = []
    for name, folder in files.children(root):
        if folder and name[0] not in "._":
            n = sum(not os.path.basename(f.path).startswith("._") for f in files.walk(f"{root}/{name}", ".gz"))
            found += [(n, name)] if n else []
    return [name for _, name in sorted(found)]


def listing(root: str, entity: str) -> list[files.Listed]:
    """The entity's ``updated_date=*/*.gz`` in order, else every ``*.gz`` below it; dot files are skipped."""
    found = [f for f in files.walk(f"{root.rstrip('/')}/{entity}", ".gz") if not os.path.basename(f.path).startswith(".")]
    dated = [f for f in found if os.path.basename(os.path.dirname(f.path)).startswith("updated_date=")]
    return dated or found


def source_files(root: str, entity: str) -> list[str]:
    return [f.path for f in listing(root, entity)]


def stride(paths: list[str], most: int = 25) -> list[str]:
    """At most ``most`` of the paths, evenly spread."""
    return paths if len(paths) <= most else [paths[int(i * len(paths) / most)] for i in range(most)]


def parse(line: Column) -> Column:
    """The record in a line; null for blank, malformed and non-object lines.  Of repeated keys the last one counts."""
    allow_repeated_keys()
    v = F.try_parse_json(F.nullif(F.trim(line), F.lit("")))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def read(spark: SparkSession, paths: list[str] | str, root: str = "") -> DataFrame:
    """``source_key, line, record`` of every line; record is null where no object can be read.

    A compressed file is read by one task.  Of a damaged one the lines before the damage are kept,
    and a file that is gone gives none; all others go on (``verify`` tells which are damaged).
    """
    lines = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(paths)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/")
    key = source_key_column(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), root.rstrip("/"))
    return lines.select(key.alias("source_key"), F.col("value").alias("line"), parse(F.col("value")).alias("record"))


def read_table(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows of a typed table as records, so that they go the same way as files; only the parts that a plan needs are read."""
    return df.select((key if key is not None else F.lit("table")).alias("source_key"), F.struct(*df.columns).alias("record"))


def losses(records: DataFrame) -> DataFrame:
    """Records, blank lines and malformed lines of each file."""
    blank = F.col("line").isNull() | (F.trim("line") == "")
    return records.groupBy("source_key").agg(
        F.count_if(F.col("record").isNotNull()).alias("records"), F.count_if(blank).alias("blank"), F.count_if(F.col("record").isNull() & ~blank).alias("malformed")
    )


def head(records: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` records of each file, for a probe of a sample."""
    left = F.row_number().over(Window.partitionBy("source_key").orderBy(F.monotonically_increasing_id()))
    return records.where("record IS NOT NULL").withColumn("_n", left).where(F.col("_n") <= n).drop("_n")


def verify(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``path, ok, n_bytes`` of compressed files (or of those in a folder), each decompressed to its end on an executor.

    A damaged or missing file is a row, not a failure, so that all others still count.
    """
    listed = [f.path for f in files.walk(paths, ".gz")] if isinstance(paths, str) else paths
    return files.checked(spark, listed, files.gunzipped, "ok boolean, n_bytes long")
