"""Filling containers of fixed capacity with documents that belong together.

Documents are measured in tokens.  What exceeds the capacity is cut into full containers and a
rest; all other documents are whole items.  Items are ordered by the terms that tell most about
them, a common one first and then a rare one, and cut into shards of fixed size; in a shard an
inverted index with BM25 weights finds, for the largest unused item (the seed), its unused
neighbours, which fill the seed's window in the order of their scores, and the best-fitting
unused items close what room is left.  The inverse document frequencies are those of the whole
corpus.  Containers that stay loose are opened again and their items cut into new shards of the
same size, first in the same order, then in a random one; one item beside which no open item
fits is done.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestloom.llm.words import Hasher, words
from nestloom.operators.graph import numbered
from nestloom.runtime import materialize, union_all

if TYPE_CHECKING:
    import tiktoken

CAPACITY = 2_048
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Items in a shard.
SHARD_ITEMS = 3_000
#: Items are packed again as long as that closes at least this share of them.
WORTHWHILE = 1 / 16
#: A container filled to less than this is opened again.
FULL = 0.97
#: Terms fall into this many buckets, which bounds the table of document frequencies.
TERM_BUCKETS = 1 << 20
_K1, _B = 1.2, 0.75
# fixed value: the published splitting pattern of this vocabulary
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ITEM = "doc_id string, row long, piece int, token_start int, n_tokens int, digest long, terms array<int>, counts array<int>"


def tokenizer(path: str) -> tiktoken.Encoding:
    """The tokenizer of the byte-pair ranks in a file."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("packing", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


def _digest(doc_id: str | None, text: str | None) -> int:
    h = blake2b(repr(doc_id).encode(), digest_size=8)
    h.update(repr(text).encode("utf-8", "surrogatepass"))
    return int.from_bytes(h.digest(), "little", signed=True)


def items(docs: DataFrame, capacity: int, path: str, buckets: int = TERM_BUCKETS) -> DataFrame:
    """The pieces of all documents: ``doc_id, row, piece, token_start, n_tokens, digest, terms, counts``.

    A document has one piece unless it exceeds the capacity.  Null and empty texts are pieces of
    no tokens.  The terms are those of the piece's own tokens; full pieces carry none, as nothing
    fits beside them.  The digest is of the id and the text.
    """

    def measure(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, hasher = tokenizer(path), Hasher()
        none = np.empty(0, np.int32)
        for batch in batches:
            out = []
            for doc_id, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
                tokens = encoding.encode_ordinary(text) if text else []
                n, digest = len(tokens), _digest(doc_id, text)
                for piece, start in enumerate(range(0, max(n, 1), capacity)):
                    size = min(capacity, n - start)
                    terms, counts = none, none
                    if 0 < size < capacity:
                        own = text if size == n else encoding.decode(tokens[start:])
                        terms, counts = np.unique((hasher(words(own)) % np.uint64(buckets)).astype(np.int32), return_counts=True)
                        counts = counts.astype(np.int32)
                    out.append((doc_id, row, piece, start, size, digest, terms, counts))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _ITEM.split(", ")])

    # ids go as text, since pandas has no integers beside nulls
    return docs.select(F.col("doc_id").cast("string"), F.monotonically_increasing_id().alias("row"), "text").mapInPandas(measure, _ITEM)


def _weights(tf: np.ndarray, lengths: np.ndarray, mean_length: float) -> np.ndarray:
    return tf * (_K1 + 1) / (tf + _K1 * (1 - _B + _B * lengths / max(mean_length, 1e-9)))


def led(loose: DataFrame, statistics: object, shard_items: int) -> DataFrame:
    """Adds ``broad`` and ``narrow``: the terms of greatest weight among those of more items than a shard holds, and among rarer shared ones; -1 for none."""

    def lead(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, idf, _ = statistics.value
        for batch in batches:
            broad, narrow = [], []
            for terms, counts in zip(batch["terms"], batch["counts"], strict=True):
                terms, tf = np.asarray(terms, np.int32), np.asarray(counts, float)
                weight, common = tf / (tf + _K1) * idf[terms], df[terms] >= shard_items
                for out, use in ((broad, common), (narrow, ~common & (df[terms] > 1))):
                    out.append(int(terms[use][np.argmax(weight[use])]) if use.any() else -1)
            yield batch.assign(broad=np.array(broad, np.int32), narrow=np.array(narrow, np.int32))

    return loose.mapInPandas(lead, f"{_ITEM}, broad int, narrow int")


def pack(sizes: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, mean_length: float, capacity: int) -> list[list[int]]:
    """Containers as lists of item numbers: seeds by size, then their BM25 neighbours, then the best fit."""
    n = len(sizes)
    lengths = np.array([c.sum() for c in counts], float)
    flat = np.concatenate(terms) if n else np.empty(0, np.int32)
    owner = np.repeat(np.arange(n), [len(t) for t in terms])
    tf = np.concatenate(counts).astype(float) if n else np.empty(0)
    weight = _weights(tf, lengths[owner], mean_length) * idf[flat]
    order = np.argsort(flat, kind="stable")
    vocabulary, first = np.unique(flat[order], return_index=True)
    ends = np.append(first[1:], len(order))
    owner, weight = owner[order], weight[order]
    slot = np.zeros(len(idf), np.int64)
    slot[vocabulary] = np.arange(len(vocabulary))
    unused = np.ones(n, bool)
    by_size = np.lexsort((np.arange(n), sizes)).tolist()
    sorted_sizes = sizes[by_size].tolist()
    top, low = n - 1, 0
    out = []
    while True:
        while top >= 0 and not unused[by_size[top]]:
            top -= 1
        if top < 0:
            return out
        seed = by_size[top]
        unused[seed] = False
        members, room = [seed], capacity - int(sizes[seed])
        while low < n and not unused[by_size[low]]:
            low += 1
        if room > 0 and len(terms[seed]) and low < n and sorted_sizes[low] <= room:
            at = slot[terms[seed]]
            spans = ends[at] - first[at]
            # the places of all postings of the seed's terms
            places = np.repeat(first[at] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            score = np.bincount(owner[places], weight[places], n)
            near = np.flatnonzero(unused & (score > 0) & (sizes <= room))
            for i in near[np.argsort(-score[near], kind="stable")].tolist():
                if sizes[i] <= room:
                    members.append(i)
                    unused[i] = False
                    room -= int(sizes[i])
                    if room == 0:
                        break
        at = bisect_right(sorted_sizes, room, 0, top) - 1
        while at >= 0:
            i = by_size[at]
            if unused[i] and sizes[i] <= room:
                members.append(i)
                unused[i] = False
                room -= int(sizes[i])
                at = min(at, bisect_right(sorted_sizes, room, 0, top))
            at -= 1
        out.append(members)


_PLACED = f"{_ITEM}, broad int, narrow int, shard long, container string, position int, filled int, largest int"
_OUT = ["container", "position", "doc_id", "piece", "token_start", "n_tokens"]


def _packer(statistics: object, capacity: int, full: float, level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, idf, mean_length = statistics.value
        pdf = pdf.sort_values(["digest", "piece", "row"], kind="stable").reset_index(drop=True)
        sizes = pdf["n_tokens"].to_numpy()
        found = pack(sizes, [np.asarray(t, np.int32) for t in pdf["terms"]], [np.asarray(c, np.int32) for c in pdf["counts"]], idf, mean_length, capacity)
        rows = [i for members in found for i in members]
        out = pdf.iloc[rows].copy()
        out["container"] = [f"{level}-{pdf['shard'].iloc[0]}-{k}" for k, members in enumerate(found) for _ in members]
        out["position"] = [p for members in found for p in range(len(members))]
        out["filled"] = [int(sizes[members].sum()) for members in found for _ in members]
        out["largest"] = [int(sizes[members].max()) for members in found for _ in members]
        # only what is packed again needs its terms
        none = np.empty(0, np.int32)
        for c in ("terms", "counts"):
            out[c] = [none if f >= full * capacity else t for f, t in zip(out["filled"], out[c], strict=True)]
        return out[[c.split()[0] for c in _PLACED.split(", ")]]

    return run


def _sharded(loose: DataFrame, shard_items: int, shuffled: int = 0) -> DataFrame:
    """Adds ``shard``: each ``shard_items`` consecutive items, in the order of their leading terms or, ``shuffled``, in a random one.

    The place in the order comes from sorted ranges; exact copies differ by their row, so that
    any number of them is cut like all others.
    """
    order = ["_key", "digest", "piece", "row"]
    key = F.xxhash64("digest", "piece", F.lit(shuffled)) if shuffled else F.struct("broad", "narrow")
    return numbered(loose.withColumn("_key", key), *order).withColumn("shard", F.floor(F.col("idx") / shard_items)).drop("_key", "idx")


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str = TOKENIZER, shard_items: int = SHARD_ITEMS, full: float = FULL) -> DataFrame:
    """``container, position, doc_id, piece, token_start, n_tokens``: every piece of every document, once.

    docs has doc_id and text; repeated rows are documents of their own.  No container holds more
    than ``capacity`` tokens, and no document of at most that many is split.  An empty table
    gives no rows.  The result depends on the documents only, not on how they are spread.
    """
    spark = docs.sparkSession
    pieces = materialize(items(docs, capacity, tokenizer_path), "pieces")
    loose = pieces.where(F.col("n_tokens") < capacity)
    # equal full pieces are counted, not gathered, and named by the document's digest and a copy number
    whole = pieces.where(F.col("n_tokens") == capacity).groupBy("doc_id", "digest", "piece", "token_start", "n_tokens").agg(F.count("*").cast("int").alias("copies"))
    whole = whole.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    whole = whole.select(F.concat_ws("-", F.lit("full"), F.lower(F.hex("digest")), "piece", "copy").alias("container"), F.lit(0).alias("position"), *_OUT[2:])
    # statistics of all items: at most one number a bucket
    mean = F.avg(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))
    n_items, mean_length = loose.agg(F.count("*"), mean).first()
    held = loose.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).toPandas()
    df = np.zeros(TERM_BUCKETS)
    df[held["t"].to_numpy(np.int64)] = held["n"].to_numpy()
    idf = np.log1p((max(n_items, 1) - df + 0.5).clip(0.5) / (df + 0.5))
    statistics = spark.sparkContext.broadcast((df.astype(np.float32), idf.astype(np.float32), mean_length or 1.0))
    # written, as the ranges' bounds are sampled before the items are sorted
    sharded = _sharded(materialize(led(loose, statistics, shard_items), "led-pieces"), shard_items)
    level, done, before, shuffled = 0, [whole], n_items, False
    while True:
        placed = materialize(sharded.groupBy("shard").applyInPandas(_packer(statistics, capacity, full, level), _PLACED), "packed")
        loose_ones = placed.where(F.col("filled") < full * capacity)
        least = loose_ones.where("n_tokens > 0").agg(F.min("n_tokens")).first()[0] or 0
        # alone, and too large for the smallest open item
        shut = (F.col("filled") >= full * capacity) | ((F.col("filled") == F.col("largest")) & (F.col("filled") + F.lit(least) > capacity))
        opened = placed.where(~shut)
        left = opened.count()
        stuck = level > 0 and before - left < WORTHWHILE * before
        if left == 0 or before <= shard_items or (stuck and shuffled):
            done.append(placed.select(*_OUT))
            return union_all(done).withColumn("doc_id", F.col("doc_id").cast("long"))
        done.append(placed.where(shut).select(*_OUT))
        level, before, shuffled = level + 1, left, shuffled or stuck
        sharded = _sharded(opened.drop("shard", "container", "position", "filled", "largest"), shard_items, level if shuffled else 0)


def packing_report(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers, items, tokens and the share of room that is used."""
    per = placed.groupBy("container").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("items"))
    return per.agg(F.count("*").alias("n_containers"), F.sum("items").alias("n_items"), F.sum("tokens").alias("n_tokens"), (F.sum("tokens") / (F.count("*") * capacity)).alias("used"))


def packing_faults(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row of counts: documents, documents that are not placed once as a whole, containers over the capacity, documents split without need.

    Documents are counted by their id and rows of one id together, as their pieces cannot be told apart.
    """
    given = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    per = placed.groupBy("doc_id").agg(F.count_if(F.col("piece") == 0).alias("first"), F.max("piece").alias("last"), F.sum("n_tokens").alias("n"))
    both = given.join(per, given["doc_id"].eqNullSafe(per["doc_id"]), "full_outer")
    documents = both.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_documents"),
        F.count_if(~F.col("rows").eqNullSafe(F.col("first"))).alias("n_misplaced"),
        F.count_if((F.col("n") <= capacity) & (F.col("last") > 0)).alias("n_split"),
    )
    rooms = placed.groupBy("container").agg(F.sum("n_tokens").alias("n")).agg(F.count_if(F.col("n") > capacity).alias("n_overfull"))
    return documents.crossJoin(rooms)
