"""Evaluation texts that leak into training documents.

Fixed masks pick some positions of every window of words (spaced seeds); windows whose picked
words agree are hits, also where the words at ignored positions were replaced.  Around each hit
the words are compared one by one: windows that agree wholly are shared passages, and the
positions that agree anyway count for the substitution-tolerant overlap.

The evaluation set is what is broadcast, in blocks of bounded size, so that a larger set means
more passes, not a larger broadcast; the documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestloom.llm.words import CJK_WORD, Hasher, words
from nestloom.runtime import spread_key, union_all

#: Masks by window length: 8 words, or 12 where each character is a word.
MASKS = {8: ("11011011", "10111101"), 12: ("110110110111", "111011101011")}
#: Characters of evaluation text in one broadcast block.
BLOCK_CHARS = 20_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(tokens: np.ndarray, offsets: list[int], span: int) -> np.ndarray:
    """A hash of the words at the offsets of each window of ``span`` words."""
    n = len(tokens) - span + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for o in offsets:
            h = (h ^ tokens[o : o + n]) * _MIX
            h ^= h >> np.uint64(29)
    return h


class SeedIndex:
    """The windows of a block of evaluation items, by mask, in the order of their hashes."""

    def __init__(self, items: list[tuple[int, str | None, str | None]]) -> None:
        hasher = Hasher()
        self.ids, self.lengths, parts, spans = [], [], [], []
        for item_id, lang, text in items:
            found = words(text)
            by_sign = lang in ("zh", "ja") if lang else 2 * sum(map(bool, map(CJK_WORD.match, found))) > len(found)
            self.ids.append(item_id)
            self.lengths.append(len(found))
            parts.append(hasher(found))
            spans.append(12 if by_sign else 8)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.owner = np.repeat(np.arange(len(self.ids)), self.lengths)
        self.seeds = []
        for span, masks in MASKS.items():
            own = np.flatnonzero(np.array(spans) == span)
            at = np.concatenate([np.arange(self.starts[i], max(self.starts[i], self.starts[i + 1] - span + 1)) for i in own] or [np.empty(0, np.int64)]).astype(np.int64)
            if not len(at):
                continue
            for mask in masks:
                offsets = [i for i, c in enumerate(mask) if c == "1"]
                h = _mixed(self.tokens, offsets, span)[at]
                order = np.argsort(h, kind="stable")
                bits = np.zeros(1 << 20, bool)
                bits[h >> np.uint64(44)] = True
                self.seeds.append((span, offsets, h[order], at[order], bits))

    def scan(self, tokens: np.ndarray, doc: np.ndarray, least_share: float = 0.0) -> dict[tuple[int, int], tuple[int, int]]:
        """(document, item) -> (words in shared passages, words in tolerant overlaps), of the words of several documents.

        Pairs that share less than ``least_share`` of the item's words are left out.
        """
        width, n_items = np.int64(len(self.tokens) + 1), np.int64(len(self.ids) + 1)
        lengths = np.array([*self.lengths, 1], np.int64)
        found: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        exact = [np.empty(0, np.int64)]
        for span, offsets, hashes, at, bits in self.seeds:
            if len(tokens) < span:
                continue
            h = _mixed(tokens, offsets, span)
            here = np.flatnonzero(bits[h >> np.uint64(44)] & (doc[: len(h)] == doc[span - 1 :]))
            if not len(here):
                continue
            # of equal windows in one document one is enough
            whole = np.zeros(len(here), np.uint64) + doc[here].astype(np.uint64)
            with np.errstate(over="ignore"):
                for o in range(span):
                    whole = (whole ^ tokens[here + o]) * _MIX
                    whole ^= whole >> np.uint64(29)
            here = here[np.unique(whole, return_index=True)[1]]
            lo, hi = np.searchsorted(hashes, h[here], "left"), np.searchsorted(hashes, h[here], "right")
            n = hi - lo
            if not n.sum():
                continue
            here, first = np.repeat(here, n), np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            there = at[first + np.arange(len(first))]
            hit = np.logical_and.reduce([tokens[here + o] == self.tokens[there + o] for o in offsets])
            here, there = here[hit], there[hit]
            full = np.logical_and.reduce([tokens[here + o] == self.tokens[there + o] for o in range(span) if o not in offsets])
            base = doc[here].astype(np.int64) * width + there
            exact += [base[full] + o for o in range(span)]
            found.append((span, here, there, base))
        shared = self._counted(exact, width, n_items)
        if least_share > 0:
            shared = {k: c for k, c in shared.items() if c >= least_share * lengths[k % n_items]}
        loose = [np.empty(0, np.int64)]
        kept = np.fromiter(shared, np.int64, len(shared))
        for span, here, there, base in found:
            if least_share > 0:
                use = np.isin(doc[here].astype(np.int64) * n_items + self.owner[there], kept)
                here, there, base = here[use], there[use], base[use]
            loose += [(base + o)[tokens[here + o] == self.tokens[there + o]] for o in range(span)]
        near = self._counted(loose, width, n_items)
        return {(int(k // n_items), int(k % n_items)): (shared.get(k, 0), c) for k, c in near.items()}

    def _counted(self, marks: list[np.ndarray], width: np.int64, n_items: np.int64) -> dict[int, int]:
        """Distinct marked words by document and item."""
        marked = np.unique(np.concatenate(marks))
        keys, counts = np.unique(marked // width * n_items + self.owner[marked % width], return_counts=True) if len(marked) else (marked, marked)
        return dict(zip(keys.tolist(), counts.tolist(), strict=True))


def leaks(docs: DataFrame, items: DataFrame, least_share: float = 0.0, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, item_words, shared_words, tolerant_words`` of every document and item with a seed hit.

    Only pairs that share at least ``least_share`` of the item's words are returned.

    docs has doc_id and text; items has item_id, lang and text.  ``shared_words`` counts the
    item's words in windows that also occur in the document, each once; ``tolerant_words`` those
    in windows that agree where a mask looks.  Null and empty texts hold nothing; repeated rows
    of one id count as their best.
    """
    items = items.select("item_id", "lang", "text").where("text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // block_chars) + 1
    spark = docs.sparkSession
    out = []
    for block in range(blocks):
        rows = items.where(spread_key(blocks, F.col("item_id")) == block) if blocks > 1 else items
        # plain data, so that executors need no copy of the class
        index = spark.sparkContext.broadcast(vars(SeedIndex([tuple(r) for r in rows.orderBy("item_id").collect()])))
        out.append(_scan(docs, index, least_share))
    found = union_all(out)
    best = [F.max(c).alias(c) for c in ("item_words", "shared_words", "tolerant_words")]
    return found.groupBy("doc_id", "item_id").agg(*best)


def _scan(docs: DataFrame, index: object, least_share: float) -> DataFrame:
    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        idx = SeedIndex.__new__(SeedIndex)
        vars(idx).update(index.value)
        for batch in batches:
            out = []
            ids, parts, held = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = words(text)
                if len(found) >= min(MASKS):
                    ids.append(doc_id)
                    parts.append(hasher(found))
                    held += len(found)
                if held > 500_000:
                    out += _found(idx, ids, parts, least_share)
                    ids, parts, held = [], [], 0
            out += _found(idx, ids, parts, least_share)
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "item_words", "shared_words", "tolerant_words"])

    # ids go as text, since pandas has no integers beside nulls
    schema = "doc_id string, item_id string, item_words int, shared_words int, tolerant_words int"
    found = docs.select(F.col("doc_id").cast("string"), "text").where(F.length("text") > 0).mapInPandas(scan, schema)
    return found.withColumns({c: F.col(c).cast("long") for c in ("doc_id", "item_id")})


def _found(idx: SeedIndex, ids: list, parts: list[np.ndarray], least_share: float) -> list[tuple]:
    if not parts:
        return []
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    hits = idx.scan(np.concatenate(parts), doc, least_share)
    name = lambda i: None if idx.ids[i] is None else str(idx.ids[i])
    return [(ids[d], name(i), idx.lengths[i], *n) for (d, i), n in hits.items()]
