"""What has to be done again: comparisons of what is there with what should be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestloom.functions.naming import local_name
from nestloom.sources import files


VERSION = "1"


def pending(sources: DataFrame, done: DataFrame, key: str = "source_key", force: bool = False, size: str | None = None) -> DataFrame:
    """Sources that aren't completed, or, by ``size``, have changed since; all of them if forced."""
    keys = sources.select(key).distinct()
    if force:
        return keys
    open_keys = keys.join(done.select(key), key, "left_anti")
    if size is None:
        return open_keys
    changed = drift(done.join(keys, key, "left_semi"), sources.select(key, size), key, size).where("change = 'changed'")
    return open_keys.unionByName(changed.select(key))


def completed(sources: DataFrame, *done: DataFrame, key: str = "source_key") -> DataFrame:
    """Keys of any of the listings that are sources of this run."""
    listed = done[0].select(key)
    for d in done[1:]:
        listed = listed.union(d.select(key))
    return listed.distinct().join(sources.select(key), key, "left_semi")


def drift(before: DataFrame, now: DataFrame, key: str, size: str) -> DataFrame:
    """``key, change``: added, removed, or changed in size (null sizes differ from known ones)."""
    a = before.select(key, F.col(size).alias("_before"), F.lit(True).alias("_in_before"))
    b = now.select(key, F.col(size).alias("_now"), F.lit(True).alias("_in_now"))
    both = a.join(b, key, "full_outer")
    change = F.when(F.col("_in_before").isNull(), "added").when(F.col("_in_now").isNull(), "removed").when(~F.col("_before").eqNullSafe(F.col("_now")), "changed")
    return both.select(key, change.alias("change")).where("change IS NOT NULL")


def drift_counts(changes: DataFrame) -> DataFrame:
    return changes.agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "changed")])


def obsolete(remote: DataFrame, local: DataFrame, key: str = "path") -> DataFrame:
    """What is published but no longer there, once object keys have local names."""
    return remote.select(local_name(F.col(key)).alias(key)).distinct().join(local.select(key), key, "left_anti")


def incomplete(tables: DataFrame, shard: str, table: str, expected: int | None = None) -> DataFrame:
    """``shard, n_tables`` of shards with fewer tables than expected; by default the most that any shard has."""
    counts = tables.groupBy(shard).agg(F.countDistinct(table).alias("n_tables"))
    if expected is not None:
        return counts.where(F.col("n_tables") < expected)
    most = counts.agg(F.max("n_tables").alias("most"))
    return counts.join(F.broadcast(most), F.col("n_tables") < F.col("most")).select(shard, "n_tables")


def in_slice(df: DataFrame, order: str, total: int, index: int) -> DataFrame:
    """Every ``total``-th row of the sorted rows, from ``index``: slice ``index`` of ``total``.

    The place of a row comes from sorted ranges, so no single task sees all rows.
    """
    from nestloom.operators.graph import numbered

    if not 0 <= index < total:
        raise ValueError(f"slice {index} of {total}")
    return numbered(df, order).where(F.col("idx") % total == index).drop("idx")


def bin_pack(files: list[tuple[str, int]], bins: int) -> list[list[str]]:
    """Files spread over bins, largest first, each to the bin with the fewest files, then the fewest bytes."""
    held: list[tuple[int, int, int, list[str]]] = [(0, 0, b, []) for b in range(max(0, bins))]
    for name, size in sorted(files, key=lambda f: (-f[1], f[0])):
        k = min(range(len(held)), key=lambda i: held[i][:3])
        n, total, b, names = held[k]
        held[k] = (n + 1, total + size, b, [*names, name])
    return [h[3] for h in held]


def batches(n: int, weight_of_one: int, budget: int = 100) -> int:
    """Jobs for n shards if one takes ``weight_of_one`` tables: heavier shards, smaller batches."""
    per_job = max(1, budget * 10 // (weight_of_one + 9))
    return -(-n // per_job)


def manifest(df: DataFrame) -> DataFrame:
    """``path, content_length, record_count`` of manifests' entries (entries array of url and meta)."""
    entry = df.select(F.explode("entries").alias("e"))
    path = F.regexp_extract("e.url", r"([^/]+/updated_date=[^/]+/[^/]+)$", 1)
    return entry.select(local_name(path).alias("path"), F.col("e.meta.content_length").alias("content_length"), F.col("e.meta.record_count").alias("record_count"))


def shard_status(sources: DataFrame, tables: DataFrame, expected: int | None = None) -> DataFrame:
    """``source_key, status``: missing (no table), incomplete, complete, or orphan (no source)."""
    counts = tables.groupBy("source_key").agg(F.countDistinct("table_name").alias("n"))
    known = counts.withColumn("_most", F.lit(expected)) if expected is not None else counts.crossJoin(F.broadcast(counts.agg(F.max("n").alias("_most"))))
    both = sources.select("source_key", F.lit(True).alias("_source")).distinct().join(known, "source_key", "full_outer")
    status = F.when(F.col("_source").isNull(), "orphan").when(F.col("n").isNull(), "missing").when(F.col("n") < F.col("_most"), "incomplete").otherwise("complete")
    return both.select("source_key", status.alias("status"))


def completed_paths(paths: DataFrame, path: str = "path") -> DataFrame:
    """``table_name, source_key`` of the shards in a listing of ``<entity>/<table>/source_key=<key>/<file>`` paths, each once."""
    shape = r"([^/]+/[^/]+)/source_key=([^/]+)/[^/]+$"
    parts = paths.select(F.regexp_extract(path, shape, 1).alias("table_name"), F.regexp_extract(path, shape, 2).alias("source_key"))
    return parts.where("source_key != ''").distinct()


def stale(local: DataFrame, remote: DataFrame, key: str = "path") -> DataFrame:
    """Local files whose object is gone, once object keys have local names; plain ``.gz`` copies count as their object."""
    kept = remote.select(local_name(F.col(key)).alias("_name")).union(remote.select(key)).distinct()
    return local.select(key).distinct().join(kept, F.col(key) == F.col("_name"), "left_anti")


def file_hashes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, length, content_hash`` of files: the first 16 digits of their SHA-256."""
    return files.checked(spark, paths, files.hashed, "length long, content_hash string")


def in_manifest(paths: DataFrame, manifest: DataFrame | None, path: str = "path") -> DataFrame:
    """The paths that a manifest lists; all of them if there is no manifest."""
    if manifest is None:
        return paths
    listed = manifest.select(F.col("path").alias("_listed"))
    return paths.join(listed, F.col(path) == F.col("_listed"), "left_semi")


def totals(changes: DataFrame, sizes: DataFrame, key: str, size: str) -> DataFrame:
    """``change, n_files, n_bytes`` of changes by the sizes in a listing; of files that it lacks no bytes are known."""
    return changes.join(sizes.select(key, size), key, "left").groupBy("change").agg(F.count("*").alias("n_files"), F.coalesce(F.sum(size), F.lit(0)).alias("n_bytes"))
