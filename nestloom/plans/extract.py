"""From source files to tables: one pass over the files, one write a table, and a record of what was done."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestloom.functions.naming import source_key, table_path
from nestloom.plans import incremental
from nestloom.plans.compile import check_columns, tables
from nestloom.plans.probe import probe
from nestloom.plans.schema import Schema
from nestloom.runtime import union_all
from nestloom.sources import files, jsonl

STATUS = "_status"
#: What is known of each file and table: rows and bytes, the schema's fingerprint and the version that wrote it.
_MARK = "source_key string, table_name string, n_rows long, n_bytes long, status string, schema_fingerprint string, version string, written_at timestamp"


def done(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The last mark of each file whose rows of a table are written; empty if nothing is."""
    empty = spark.createDataFrame([], _MARK)
    if not files.exists(f"{out}/{STATUS}"):
        return empty
    marks = spark.read.schema(empty.schema).parquet(f"{out}/{STATUS}").where(F.col("table_name") == table)
    rest = [c for c in empty.columns if c != "source_key"]
    return marks.groupBy("source_key").agg(F.max_by(F.struct(*rest), "written_at").alias("m")).select("source_key", "m.*")


def _sources(spark: SparkSession, root: str, entity: str, slice_of: tuple[int, int] | None) -> DataFrame:
    listed = jsonl.listing(root, entity)
    if slice_of:
        listed = listed[slice_of[1] :: slice_of[0]]
    return spark.createDataFrame([(source_key(f.path, root.rstrip("/")), f.path, f.n_bytes) for f in listed], "source_key string, path string, n_bytes long")


def _names(schema: Schema, wanted: Iterable[str] | None, exclude: Iterable[str]) -> list[str]:
    return [t for t in dict.fromkeys(wanted or [schema.main, *schema.table_names()]) if t not in set(exclude)]


def _pending(spark: SparkSession, sources: DataFrame, out: str, table: str, force: bool) -> DataFrame:
    return incremental.pending(sources, done(spark, out, table), force=force, size="n_bytes").join(sources, "source_key")


def pending_files(
    spark: SparkSession, root: str, schema: Schema, out: str, force: bool = False, wanted: Iterable[str] | None = None, exclude: Iterable[str] = (), slice_of: tuple[int, int] | None = None
) -> DataFrame:
    """``table_name, n_files, n_bytes`` of what ``extract`` would read."""
    sources = _sources(spark, root, schema.entity, slice_of)
    open_files = [_pending(spark, sources, out, t, force).agg(F.lit(t).alias("table_name"), F.count("*").alias("n_files"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes")) for t in _names(schema, wanted, exclude)]
    return union_all(open_files)


def extract(
    spark: SparkSession, root: str, schema: Schema, out: str, force: bool = False, wanted: Iterable[str] | None = None, exclude: Iterable[str] = (), slice_of: tuple[int, int] | None = None,
    strict: bool = True, verify: bool = True,
) -> DataFrame:
    """Write the tables of an entity's pending files; returns ``table_name, status, n_files, n_damaged``.

    Tables lie in ``out/<entity>/<table>/source_key=...``; a file's rows of a table replace those
    of an earlier run, and nothing else is touched.  A file is pending if it has no mark in the
    status table, or if its size is not the marked one.  Every table is written with the
    canonical columns; files without rows of a table count as done.  ``slice_of`` (total, index)
    takes every total-th file.

    ``strict``: data whose tables would have columns that the schema lacks raise
    ``UnexpectedColumns``, which names them, before anything is written.  ``verify``: files that
    cannot be read to their end are marked as damaged; their readable lines are written, and the
    other files go on.
    """
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    sources = _sources(spark, root, schema.entity, slice_of)
    names = _names(schema, wanted, exclude)
    todo = {t: _pending(spark, sources, out, t, force).persist() for t in names}
    n_open = {t: todo[t].count() for t in names}
    result = [(t, "skipped", 0, 0) for t in names if not n_open[t]]
    paths = sorted({r[0] for t in names if n_open[t] for r in todo[t].select("path").collect()})  # a part of the listing above
    if paths:
        damaged = spark.createDataFrame([], "path string")
        if verify:
            damaged = jsonl.verify(spark, paths).where("NOT ok").select("path").persist()
        damaged = sources.join(damaged, "path").select("source_key", F.lit("damaged").alias("damage"))
        records = jsonl.read(spark, paths, root).persist(StorageLevel.MEMORY_AND_DISK)
        if strict:
            check_columns(probe(records, schema.entity, empty_fields=False), schema)
        built = tables(records, schema, [t for t in names if n_open[t]])
        for table in [t for t in names if n_open[t]]:
            folder, mine = f"{out}/{table_path(table)}", todo[table]
            counts = spark.createDataFrame([], "source_key string, n_rows long")
            _drop(spark, folder, mine)  # a file may have no rows of this table any more
            if table in built:
                rows = built[table] if n_open[table] == len(paths) else built[table].join(mine.select("source_key"), "source_key", "left_semi")
                rows.select(*[c for c in rows.columns if c != "source_key"], "source_key").write.mode("overwrite").partitionBy("source_key").parquet(folder)
                if any(name.startswith("source_key=") for name, _ in files.children(folder)):
                    counts = spark.read.parquet(folder).join(mine.select("source_key"), "source_key", "left_semi").groupBy("source_key").agg(F.count("*").alias("n_rows"))
            n_rows = F.coalesce("n_rows", F.lit(0))
            status = F.coalesce("damage", F.when(n_rows == 0, "empty").otherwise("complete"))
            marks = mine.join(counts, "source_key", "left").join(damaged, "source_key", "left").select(
                "source_key", F.lit(table).alias("table_name"), n_rows.alias("n_rows"), "n_bytes", status.alias("status"), F.lit(schema.fingerprint).alias("schema_fingerprint"),
                F.lit(incremental.VERSION).alias("version"), F.current_timestamp().alias("written_at"),
            )
            marks.coalesce(1).write.mode("append").parquet(f"{out}/{STATUS}")
            result.append((table, "written", n_open[table], damaged.join(mine, "source_key").count()))
        records.unpersist()
    for t in todo.values():
        t.unpersist()
    return spark.createDataFrame(result, "table_name string, status string, n_files int, n_damaged int")


def _drop(spark: SparkSession, folder: str, keys: DataFrame) -> None:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    there = {name for name, _ in files.children(folder)}
    for row in keys.select("source_key").toLocalIterator():
        name = f"source_key={escape(row[0])}"
        if name in there:
            files.delete(f"{folder}/{name}")


def status_totals(spark: SparkSession, out: str, tables: Iterable[str]) -> DataFrame:
    """``table_name``, and of its files: how many are complete, empty and damaged, their rows and bytes."""
    states = [F.count_if(F.col("status") == c).alias(c) for c in ("complete", "empty", "damaged")]
    return union_all([done(spark, out, t) for t in tables]).groupBy("table_name").agg(*states, F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))


def validate(table: DataFrame, status: DataFrame) -> DataFrame:
    """``source_key, expected, found`` of files whose rows are not those that were written."""
    found = table.groupBy("source_key").agg(F.count("*").alias("found"))
    expected = status.select("source_key", F.col("n_rows").alias("expected"))
    both = expected.join(found, "source_key", "full_outer").select("source_key", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.where("expected != found")


def content_hash(df: DataFrame, *columns: str) -> DataFrame:
    """An order-free hash of a table's rows by file: 16 hexadecimal digits."""
    cells = columns or tuple(c for c in df.columns if c != "source_key")
    return df.groupBy("source_key").agg(F.count("*").alias("n_rows"), F.lpad(F.hex(F.bit_xor(F.xxhash64(*cells))), 16, "0").alias("content_hash"))
