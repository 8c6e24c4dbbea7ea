"""Items that appear together, measured against a bipartite configuration null.

Pairs are counted exactly.  The null is the maximum-entropy ensemble of item-basket graphs that
keeps every item's frequency and every basket's size in expectation: item i is in basket b with
probability x_i y_b / (1 + x_i y_b), where x depends only on the frequency and y only on the
size, so it is fitted on the two histograms.  Under it a pair's count is a sum of independent
unequal coin flips (Poisson-binomial); its upper tail is taken by the saddlepoint formula, which
is accurate in relative terms far out, and Benjamini-Hochberg turns tails into q-values.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nestloom.runtime import materialize, spread_key, union_all

#: Baskets with more items than this are not gathered in one row; their pairs come from a join of item blocks.
BASKET_ITEMS = 512
#: Width of the bins of -log10 p in which false discoveries are counted; a bin takes its largest p.
TAIL_STEP = 0.01
#: All stronger tails share a bin.
TAIL_TOP = 320.0
#: The null is fitted in blocks of so many cells, until the logarithms of its fitnesses move less, or fails.
FIT_CELLS, FIT_STILL, FIT_ROUNDS = 1 << 22, 1e-8, 100_000


def incidences(df: DataFrame, basket: Column, fields: dict[str, Column]) -> DataFrame:
    """``field_name, basket, item``, each once.

    ``fields`` maps names to arrays of item names.  Null baskets and items are left out; the rows
    of one basket are taken together.
    """
    base = df.select(basket.alias("basket"), *[a.alias(f"_{i}") for i, a in enumerate(fields.values())]).where("basket IS NOT NULL")
    named = F.array(*[
        F.struct(F.lit(name).alias("field_name"), F.array_distinct(F.array_compact(F.coalesce(f"_{i}", F.array().cast("array<string>")))).alias("items"))
        for i, name in enumerate(fields)
    ])
    return base.select("basket", F.inline(named)).select("field_name", "basket", F.explode("items").alias("item")).distinct()


def pair_counts(inc: DataFrame, n_baskets: int, min_count: int, min_lift: float = 0.0, basket_items: int = BASKET_ITEMS) -> DataFrame:
    """``field_name, item_a, item_b, n_a, n_b, n_ab`` of pairs in at least ``min_count`` baskets.

    An item in fewer baskets than ``min_count`` is in no such pair.  As n_ab <= min(n_a, n_b), a
    pair of lift ``min_lift`` needs max(n_a, n_b) * min_lift <= n_baskets, so a more frequent item
    is in no such pair either: both are left out before pairs are made, without any loss.
    """
    counts = inc.groupBy("field_name", "item").agg(F.count("*").alias("n"))
    useful = F.col("n") >= min_count
    if min_lift > 0:
        useful &= F.col("n") * min_lift <= n_baskets
    kept = inc.join(counts.where(useful), ["field_name", "item"])
    sizes = kept.groupBy("field_name", "basket").agg(F.count("*").alias("size"))
    huge = sizes.where(F.col("size") > basket_items).select("field_name", "basket")
    entry = F.struct("item", "n")
    small = kept.join(huge, ["field_name", "basket"], "left_anti").groupBy("field_name", "basket")
    baskets = small.agg(F.array_sort(F.collect_list(entry)).alias("items")).where(F.size("items") > 1)
    pairs = baskets.select("field_name", "items", F.posexplode("items").alias("pos", "a"))
    pairs = pairs.select("field_name", "a", F.explode(F.slice("items", F.col("pos") + 2, F.size("items"))).alias("b"))
    in_huge = kept.join(huge, ["field_name", "basket"])
    left = in_huge.select("field_name", "basket", entry.alias("a"), spread_key(64, F.col("item")).alias("block"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(63))))
    right = in_huge.select("field_name", "basket", entry.alias("b"), spread_key(64, F.col("item")).alias("other"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(63))))
    large = left.join(right, ["field_name", "basket", "block", "other"]).where(F.col("a.item") < F.col("b.item"))
    flat = [F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")]
    both = union_all([pairs.select("field_name", *flat), large.select("field_name", *flat)])
    counted = both.groupBy("field_name", "item_a", "item_b", "n_a", "n_b").agg(F.count("*").alias("n_ab"))
    return counted.where(F.col("n_ab") >= min_count)


def fit_null(freq: np.ndarray, n_items: np.ndarray, size: np.ndarray, n_baskets: np.ndarray, rounds: int = FIT_ROUNDS, cells: int = FIT_CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Fitnesses x of item classes and y of basket classes that keep frequencies and sizes in expectation.

    The table of item and basket classes is never whole in memory: sums over it are taken in
    blocks of ``cells``.  Without convergence in ``rounds`` rounds the fit fails.
    """
    freq, size = freq.astype(float), size.astype(float)
    if not len(freq) or not len(size):
        return freq, size
    total = max(1.0, float((freq * n_items).sum()))
    x, y = freq / math.sqrt(total), size / math.sqrt(total)
    step = max(1, cells // max(1, len(size)))
    blocks = [slice(i, i + step) for i in range(0, len(freq), step)]
    for _ in range(rounds):
        old = x
        x = np.concatenate([freq[b] / (n_baskets * y / (1 + np.outer(x[b], y))).sum(1) for b in blocks])
        y = size / sum((n_items[b, None] * x[b, None] / (1 + np.outer(x[b], y))).sum(0) for b in blocks)
        if np.max(np.abs(np.log(x / old))) < FIT_STILL:
            return x, y
    raise RuntimeError(f"the null has not converged in {rounds} rounds")


def tail_log10(q: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """-log10 P(X >= at), X the sum over k of Binomial(n[k], q[r, k]), for each row r.

    The tail is exact where all flips must succeed; else it is the Lugannani-Rice formula with
    the second continuity correction, and near the mean the normal tail with the same correction.
    """
    at = at.astype(float)
    mean = (n * q).sum(1)
    out = np.zeros(len(at))
    reach = (n * (q > 0)).sum(1)
    out[at > reach] = np.inf
    sure = (at == reach) & (at > 0)
    if sure.any():
        with np.errstate(divide="ignore"):
            out[sure] = -np.where(q[sure] > 0, n * np.log(np.where(q[sure] > 0, q[sure], 1)), 0).sum(1) / math.log(10)
    do = np.flatnonzero((at > 0) & (at < reach) & (at - 0.5 > mean + 1e-9))
    if len(do):
        p, m = q[do], at[do] - 0.5
        lo, hi = np.zeros(len(do)), np.full(len(do), 60.0)
        s = np.full(len(do), 0.1)
        for _ in range(80):
            t = p * np.exp(s)[:, None] / (1 - p + p * np.exp(s)[:, None])
            k1, k2 = (n * t).sum(1) - m, (n * t * (1 - t)).sum(1)
            lo, hi = np.where(k1 < 0, s, lo), np.where(k1 < 0, hi, s)
            step = s - k1 / np.maximum(k2, 1e-300)
            s, last = np.where((step > lo) & (step < hi), step, (lo + hi) / 2), s
            if np.max(np.abs(s - last)) < 1e-10:
                break
        t = p * np.exp(s)[:, None] / (1 - p + p * np.exp(s)[:, None])
        k0 = (n * np.log1p(p * np.expm1(s)[:, None])).sum(1)
        k2 = (n * t * (1 - t)).sum(1)
        w = np.sqrt(np.maximum(2 * (s * m - k0), 0))
        u = 2 * np.sinh(s / 2) * np.sqrt(k2)
        log_phi = -0.5 * w * w - 0.5 * math.log(2 * math.pi)
        # Q(w) / phi(w), by the continued fraction of Mills' ratio where w is large
        mills = np.where(w > 6, 1 / (w + 1 / (w + 2 / (w + 3 / (w + 4 / np.maximum(w, 1))))), _mills(np.minimum(w, 6)))
        factor = np.where(w > 1e-4, mills + 1 / np.maximum(u, 1e-12) - 1 / np.maximum(w, 1e-12), mills)
        out[do] = -(log_phi + np.log(np.maximum(factor, 1e-300))) / math.log(10)
    near = np.flatnonzero((at > 0) & (at < reach) & (at - 0.5 <= mean + 1e-9))
    if len(near):
        sd = np.sqrt(np.maximum((n * q[near] * (1 - q[near])).sum(1), 1e-12))
        z = (at[near] - 0.5 - mean[near]) / sd
        out[near] = -np.log10([max(1e-300, 0.5 * math.erfc(v / math.sqrt(2))) for v in z])
    return np.maximum(out, 0)


def _mills(w: np.ndarray) -> np.ndarray:
    return np.array([math.sqrt(math.pi / 2) * math.erfc(v / math.sqrt(2)) * math.exp(v * v / 2) for v in w])


def surprise(pairs: DataFrame, freq_hist: pd.DataFrame, size_hist: pd.DataFrame, n_baskets: int) -> DataFrame:
    """Adds ``lift, expected, tail`` (-log10 p) and ``q_tail`` (-log10 q) to pair counts.

    The histograms (field_name, value, n) are the distinct item frequencies and basket sizes with
    their counts; they stay small, as c distinct frequencies need about c*c/2 incidences.
    """
    models = {}
    for field in sorted(set(freq_hist["field_name"])):
        f, s = freq_hist[freq_hist["field_name"] == field], size_hist[size_hist["field_name"] == field]
        freq, size = f["value"].to_numpy(), s["value"].to_numpy()
        x, y = fit_null(freq, f["n"].to_numpy(), size, s["n"].to_numpy())
        models[field] = (dict(zip(freq.tolist(), x, strict=True)), y, s["n"].to_numpy().astype(float))
    possible = {f: int(g["n"].sum()) for f, g in freq_hist.groupby("field_name")}
    model = pairs.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("expected double, tail double")
    def null_of(field: pd.Series, n_a: pd.Series, n_b: pd.Series, n_ab: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(field), 2))
        case = pd.DataFrame({"f": field, "a": n_a, "b": n_b, "m": n_ab})
        for name, group in case.groupby("f", sort=False):
            x, y, n = model.value[name]
            # the null depends on the two frequencies and the count only
            distinct, back = np.unique(group[["a", "b", "m"]].to_numpy(), axis=0, return_inverse=True)
            back = back.reshape(-1)
            got = np.empty((len(distinct), 2))
            for at in range(0, len(distinct), 2000):
                part = distinct[at : at + 2000]
                xa, xb = (np.array([x[v] for v in part[:, c]]) for c in (0, 1))
                pa, pb = np.outer(xa, y), np.outer(xb, y)
                q = pa / (1 + pa) * (pb / (1 + pb))
                got[at : at + 2000, 0] = (n * q).sum(1)
                got[at : at + 2000, 1] = tail_log10(q, n, part[:, 2])
            out[group.index.to_numpy()] = got[back]
        return pd.DataFrame(out, columns=["expected", "tail"])

    lift = F.col("n_ab") * F.lit(float(n_baskets)) / (F.col("n_a").cast("double") * F.col("n_b"))
    scored = pairs.withColumn("lift", lift).withColumn("_null", null_of("field_name", "n_a", "n_b", "n_ab")).select("*", "_null.*").drop("_null")
    bin_of = F.least(F.floor(F.col("tail") / TAIL_STEP), F.lit(int(TAIL_TOP / TAIL_STEP))).cast("long")
    scored = materialize(scored.withColumn("tail_bin", bin_of), "pair-surprise")
    # at most TAIL_TOP / TAIL_STEP bins a field
    bins = scored.groupBy("field_name", "tail_bin").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("field_name").orderBy(F.desc("tail_bin")))
    tests = F.create_map(*[F.lit(v) for f, v in possible.items() for v in (f, v * (v - 1) / 2)]) if possible else F.create_map(F.lit(""), F.lit(1.0))
    q = F.col("tail_bin") * TAIL_STEP - F.log10(tests[F.col("field_name")] / F.col("rank"))
    best = F.max("q").over(Window.partitionBy("field_name").orderBy("tail_bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = bins.withColumn("rank", above).withColumn("q", q).select("field_name", "tail_bin", F.greatest(F.lit(0.0), best).alias("q_tail"))
    return scored.join(F.broadcast(ranked), ["field_name", "tail_bin"]).drop("tail_bin")


def cooccurring(df: DataFrame, basket: Column, fields: dict[str, Column], min_count: int = 5, min_lift: float = 0.0) -> DataFrame:
    """``field_name, item_a, item_b, n_a, n_b, n_ab, lift, expected, tail, q_tail`` of pairs with item_a < item_b.

    Counts are in distinct baskets of ``df``; baskets without items count for the lift only.
    Pairs in fewer than ``min_count`` baskets, or of less lift than ``min_lift``, are left out.
    ``q_tail`` counts every pair of items of the field as a test.  Empty tables give no rows.
    """
    n_baskets = df.select(basket.alias("b")).where("b IS NOT NULL").distinct().count()
    inc = materialize(incidences(df, basket, fields), "incidences")
    freq = inc.groupBy("field_name", "item").agg(F.count("*").alias("value")).groupBy("field_name", "value").agg(F.count("*").alias("n"))
    sizes = inc.groupBy("field_name", "basket").agg(F.count("*").alias("value")).groupBy("field_name", "value").agg(F.count("*").alias("n"))
    found = pair_counts(inc, n_baskets, min_count, min_lift)
    order = ["field_name", "value"]
    scored = surprise(found, freq.toPandas().sort_values(order), sizes.toPandas().sort_values(order), n_baskets)
    return scored.where(F.col("n_ab") * F.lit(n_baskets) >= F.lit(min_lift) * F.col("n_a") * F.col("n_b"))
