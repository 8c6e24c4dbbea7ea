"""What changed between consecutive full snapshots of a table.

Every row is reduced to a digest.  Keys fall into hash ranges; the ranges are the leaves of one
Merkle tree per snapshot.  The trees of two consecutive snapshots are compared from the root
down, following only nodes whose digests differ, and rows are compared only in the leaves that
the comparison reaches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestloom.runtime import materialize

FANOUT_BITS = 4


def digest(*cols: Column) -> Column:
    """A 64-bit digest in which a null differs from every value and from a null elsewhere."""
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(nulls, *cols)


def latest_states(df: DataFrame, key: Column, snapshot: Column, version: Column, state: list[Column]) -> DataFrame:
    """One row per (snapshot, key): ``snapshot, key, row_digest`` of the row with the greatest version.

    Equal versions are settled by the digest.  Rows without key or snapshot are no records.
    """
    rows = df.select(snapshot.alias("snapshot"), key.alias("key"), version.alias("version"), digest(*state).alias("row_digest"))
    rows = rows.where(F.col("key").isNotNull() & F.col("snapshot").isNotNull())
    best = F.max(F.struct("version", "row_digest"))["row_digest"].alias("row_digest")
    return rows.groupBy("snapshot", "key").agg(best)


def leaf_bits(rows: int, rows_per_leaf: int) -> int:
    """Bits of the leaf number so that a leaf holds about ``rows_per_leaf`` rows."""
    return max(FANOUT_BITS, FANOUT_BITS * math.ceil(math.log2(max(2, rows / rows_per_leaf)) / FANOUT_BITS))


def differing_leaves(rows: DataFrame, follows: DataFrame, bits: int) -> DataFrame:
    """(snapshot, leaf) whose digests differ from the preceding snapshot, found from the root down.

    ``rows`` has snapshot, leaf, row_hash; ``follows`` has snapshot and previous, null for the first.
    """
    leaves = materialize(
        rows.groupBy("snapshot", "leaf").agg(F.bit_xor("row_hash").alias("d"), F.count("*").alias("n")), "merkle-leaves"
    )
    levels = [leaves]
    for _ in range(bits // FANOUT_BITS):
        children = levels[-1].select("snapshot", F.shiftright("leaf", FANOUT_BITS).alias("up"), "leaf", "d", "n")
        up = children.groupBy("snapshot", F.col("up").alias("leaf"))
        # written, as each level is read for itself and for the one above it
        levels.append(materialize(up.agg(F.bit_xor(F.xxhash64(children["leaf"], "d", "n")).alias("d"), F.sum("n").alias("n")), "merkle-level"))
    follows = follows.where("previous IS NOT NULL")
    open_nodes = None
    for level in reversed(levels):
        # each node once for its own snapshot and once for the snapshot that follows it
        now = level.join(F.broadcast(follows.select("snapshot")), "snapshot").select("snapshot", "leaf", "d", "n", F.lit(1).alias("side"))
        before = level.join(F.broadcast(follows.select(F.col("snapshot").alias("next"), F.col("previous").alias("snapshot"))), "snapshot")
        before = before.select(F.col("next").alias("snapshot"), "leaf", "d", "n", F.lit(0).alias("side"))
        both = now.unionByName(before)
        if open_nodes is not None:
            parents = open_nodes.select("snapshot", F.col("leaf").alias("parent"))
            # merged, as the open nodes grow with the data
            both = both.withColumn("parent", F.shiftright("leaf", FANOUT_BITS)).join(parents.hint("merge"), ["snapshot", "parent"], "left_semi")
        node = F.struct("d", "n")
        sides = both.groupBy("snapshot", "leaf").agg(
            F.max(F.when(F.col("side") == 1, node)).alias("now"), F.max(F.when(F.col("side") == 0, node)).alias("before")
        )
        open_nodes = materialize(sides.where(~F.col("now").eqNullSafe(F.col("before"))).select("snapshot", "leaf"), "merkle-open")
    return open_nodes


def snapshot_changes(df: DataFrame, key: Column, snapshot: Column, version: Column, state: list[Column], rows_per_leaf: int = 8) -> DataFrame:
    """``snapshot, key, change_kind`` (added, removed, changed) against the preceding snapshot.

    key, snapshot and version are columns of ``df``; ``state`` lists the normalised columns whose
    difference counts.  Repeated rows of a key in a snapshot count once, in their latest version;
    null versions come first.  The first snapshot, and an empty table, give no rows.
    """
    states = materialize(latest_states(df, key, snapshot, version, state), "snapshot-states")
    dates = states.groupBy("snapshot").count()
    found = dates.agg(F.max("count")).first()[0]
    bits = leaf_bits(found or 0, rows_per_leaf)
    # one row per snapshot, so the window's single task is as small as the calendar
    follows = materialize(dates.select("snapshot", F.lag("snapshot").over(Window.orderBy("snapshot")).alias("previous")), "snapshots")
    rows = states.join(F.broadcast(follows), "snapshot").select(
        "snapshot", "previous", "key", "row_digest", F.xxhash64("key", "row_digest").alias("row_hash"),
        F.shiftrightunsigned(F.xxhash64("key"), 64 - bits).alias("leaf"),
    )
    changed = differing_leaves(rows, follows, bits)
    after = follows.where("previous IS NOT NULL").select(F.col("previous").alias("snapshot"), F.col("snapshot").alias("next"))
    now = rows.where("previous IS NOT NULL").select("snapshot", "leaf", "key", F.col("row_digest").alias("now"), F.lit(None).cast("long").alias("before"))
    before = rows.join(F.broadcast(after), "snapshot").select(F.col("next").alias("snapshot"), "leaf", "key", F.lit(None).cast("long").alias("now"), F.col("row_digest").alias("before"))
    both = now.unionByName(before).join(changed.hint("merge"), ["snapshot", "leaf"], "left_semi")
    pairs = both.groupBy("snapshot", "leaf", "key").agg(F.max("now").alias("now"), F.max("before").alias("before"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("changed")
    return pairs.where(~F.col("now").eqNullSafe(F.col("before"))).select("snapshot", "key", kind.alias("change_kind"))
