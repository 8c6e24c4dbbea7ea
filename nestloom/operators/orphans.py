"""References to records that do not exist.

The references are counted per key and period first.  A key that holds a large share of them is
*heavy*; a share can be large for a bounded number of keys only, so what is known about those is
broadcast and their references never cross the network.  All other references meet the known
keys in a shuffled outer join, whose unmatched rows are the missing ones; both parts are united.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestloom.runtime import materialize

#: A key is heavy if it holds more than 1/HEAVY_SHARE of all references; so there are fewer heavy keys than this.
HEAVY_SHARE = 1000


def arrivals(rows: DataFrame, key: Column, loaded_at: Column) -> DataFrame:
    """``key, first_loaded, last_loaded`` of each key; rows without key are no records."""
    known = rows.select(key.alias("key"), loaded_at.alias("at")).where("key IS NOT NULL")
    return known.groupBy("key").agg(F.min("at").alias("first_loaded"), F.max("at").alias("last_loaded"))


def key_facts(kind: str, rows: DataFrame, key: Column, loaded_at: Column, tombstones: DataFrame) -> DataFrame:
    """``target_kind, key, first_loaded, last_loaded, is_deleted, has_row`` of every key with a row or a tombstone.

    ``tombstones`` has key and deleted_at.  A key is deleted if no row of it was loaded after its
    latest tombstone; a tombstone without time counts only for keys without rows.
    """
    dead = tombstones.where("key IS NOT NULL").groupBy("key").agg(F.max("deleted_at").alias("deleted_at"), F.lit(True).alias("dead"))
    live = arrivals(rows, key, loaded_at).withColumn("live", F.lit(True))
    both = live.join(dead, "key", "full_outer")
    has_row = F.coalesce("live", F.lit(False))
    outlived = F.coalesce(F.col("last_loaded") > F.col("deleted_at"), has_row & (F.col("last_loaded").isNull() | F.col("deleted_at").isNull()))
    deleted = F.coalesce("dead", F.lit(False)) & ~outlived
    return both.select(F.lit(kind).alias("target_kind"), "key", "first_loaded", "last_loaded", deleted.alias("is_deleted"), has_row.alias("has_row"))


def references(df: DataFrame, source_key: Column, loaded_at: Column, fields: dict[str, tuple[str, Column]]) -> DataFrame:
    """``field_name, target_kind, source_key, target_key, arrived``: the distinct references of each source.

    ``fields`` maps a field's name to the kind of its targets and a column with the array of
    their keys.  A source arrives with the earliest of its rows, with or without references.
    Null items and null or empty arrays are no references.
    """
    base = df.select(source_key.alias("source_key"), loaded_at.alias("at"), *[a.alias(f"_{i}") for i, (_, a) in enumerate(fields.values())])
    base = base.where("source_key IS NOT NULL")
    named = F.array(*[
        F.struct(F.lit(name).alias("field_name"), F.lit(kind).alias("target_kind"), F.array_distinct(F.coalesce(f"_{i}", F.array().cast("array<bigint>"))).alias("keys"))
        for i, (name, (kind, _)) in enumerate(fields.items())
    ])
    refs = base.select("source_key", F.inline(named)).select("source_key", "field_name", "target_kind", F.explode("keys").alias("target_key"))
    refs = refs.where("target_key IS NOT NULL").distinct()
    arrived = base.groupBy("source_key").agg(F.min("at").alias("arrived"))
    return refs.join(arrived, "source_key")


def orphan_references(refs: DataFrame, facts: DataFrame, heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """The references of ``references`` whose target is deleted, missing or late, with ``load_period`` and ``orphan_kind``.

    deleted: see ``key_facts``; else missing: no row; else late: first loaded after the source
    arrived.  Unknown times are never late; ``load_period`` is then null.
    """
    refs = materialize(refs.withColumn("load_period", F.date_format("arrived", "yyyy-MM")), "references")
    volumes = refs.groupBy("target_kind", "target_key", "load_period").agg(F.count("*").alias("n"))
    per_key = volumes.groupBy("target_kind", "target_key").agg(F.sum("n").alias("n"))
    floor = refs.count() / heavy_share
    # fewer than heavy_share keys can hold more than that share of all references
    heavy = [(r[0], r[1]) for r in per_key.where(F.col("n") > floor).select("target_kind", "target_key").collect()]
    facts = facts.withColumnRenamed("key", "target_key")
    on = ["target_kind", "target_key"]
    if not heavy:
        return _orphans(refs.join(facts, on, "left"))
    heavy_keys = F.broadcast(refs.sparkSession.createDataFrame(heavy, "target_kind string, target_key bigint"))
    heavy_facts = F.broadcast(heavy_keys.join(facts, on, "left"))
    hot = _orphans(refs.join(heavy_facts, on))
    rest = _orphans(refs.join(heavy_keys, on, "left_anti").join(facts, on, "left"))
    return hot.unionByName(rest)


def _orphans(joined: DataFrame) -> DataFrame:
    kind = (
        F.when(F.coalesce("is_deleted", F.lit(False)), "deleted")
        .when(~F.coalesce("has_row", F.lit(False)), "missing")
        .when(F.col("first_loaded") > F.col("arrived"), "late")
    )
    return joined.select("field_name", "load_period", "source_key", "target_key", kind.alias("orphan_kind")).where("orphan_kind IS NOT NULL")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references and distinct orphaned targets per field, period and kind."""
    per_target = orphans.groupBy("field_name", "load_period", "orphan_kind", "target_key").agg(F.count("*").alias("n"))
    return per_target.groupBy("field_name", "load_period", "orphan_kind").agg(F.sum("n").alias("n_references"), F.count("*").alias("n_targets"))
