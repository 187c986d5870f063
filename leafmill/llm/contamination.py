"""Benchmark decontamination: short test items inside long documents.

MinHash containment search: an item is represented by its smallest shingle hashes, and each of
them is looked up in the shingles of a document, so the estimate does not suffer from the
document's length. Items are partitioned by size; each partition has the sketch size from which on no item
of it can be missed: when at least ``threshold`` of n shingles are in a document, at most
(1 - threshold) n are not, so of one more than that at least one is found. Documents with a hit are
verified by the exact share of the item's shingles (tuples of words) that they hold.
"""

import math
from collections import defaultdict
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import SHINGLE, WordHashes, appended, mixed, shingle_hashes, words_of


def size_class(n: int) -> int:
    """Partition of an item with ``n`` shingles: sizes double from one to the next."""
    return n.bit_length()


def sketch_size(n_class: int, threshold: float) -> int:
    """Smallest hashes kept of each item of a partition; enough for its largest item."""
    largest = (1 << n_class) - 1
    return math.floor((1 - threshold) * largest + 1e-9) + 1


def hash_rows(rows: np.ndarray) -> np.ndarray:
    """As ``shingle_hashes``, of windows given as rows of word hashes."""
    out = np.full(len(rows), rows.shape[1], np.uint64)
    for k in range(rows.shape[1]):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += rows[:, k]
        out ^= out >> np.uint64(29)
    return mixed(out)


class Items:
    """A block of items with sketches by partition, and their exact shingles."""

    def __init__(self, rows: list[tuple], threshold: float):
        self.threshold = threshold
        hashes = WordHashes()
        self.numbers: dict[bytes, int] = {}
        self.shingles: list[set[tuple]] = []
        self.ids = []
        sketch = defaultdict(list)
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            at = len(self.ids)
            self.ids.append(item_id)
            span = min(SHINGLE, len(words))
            self.shingles.append({tuple(words[i:i + span]) for i in range(len(words) - span + 1)})
            for w in words:
                self.numbers.setdefault(w, len(self.numbers) + 1)
            distinct = np.unique(shingle_hashes(words, hashes))
            for h in distinct[:sketch_size(size_class(len(distinct)), threshold)]:
                sketch[int(h)].append(at)
        # The sketch of this block by the numbers of its words: what a document's words are turned into.
        self.word_hash = np.zeros(len(self.numbers) + 1, np.uint64)
        for w, k in self.numbers.items():
            self.word_hash[k] = hashes[w]
        self.keys = np.array(sorted(sketch), np.uint64)
        self.owners = [sketch[int(k)] for k in self.keys]
        self.short = [k for k, s in enumerate(self.shingles) if len(next(iter(s))) < SHINGLE]

    def hits(self, words: list[bytes]) -> set[int]:
        """Items with a sketch hash among the shingles of ``words``."""
        ids = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        found: set[int] = set()
        spans = {SHINGLE} | {len(next(iter(self.shingles[k]))) for k in self.short}
        for span in spans:
            if len(ids) < span:
                continue
            windows = len(ids) - span + 1
            known = np.ones(windows, bool)
            for k in range(span):
                known &= ids[k:k + windows] > 0
            places = np.flatnonzero(known)
            if len(places):
                rows = self.word_hash[ids[places[:, None] + np.arange(span)]]
                hashed = hash_rows(rows)
                at = np.searchsorted(self.keys, hashed).clip(max=len(self.keys) - 1)
                for k in np.unique(at[self.keys[at] == hashed]):
                    found.update(self.owners[k])
        return found

    def matches(self, text: bytes | None) -> list[tuple[int, int, int]]:
        """(item, shingles of it in the text, shingles of it) of the items contained."""
        words = words_of(text)
        if not words or not len(self.keys):
            return []
        out, held = [], {}
        for k in sorted(self.hits(words)):
            wanted = self.shingles[k]
            span = len(next(iter(wanted)))
            if span not in held:
                held[span] = set(zip(*[words[i:] for i in range(span)], strict=False))
            n = len(wanted & held[span])
            if n >= self.threshold * len(wanted) - 1e-9:
                out.append((k, n, len(wanted)))
        return out


def flagged(docs: DataFrame, items: DataFrame, threshold: float = 0.8, block_bytes: int = 32 << 20) -> DataFrame:
    """Add ``benchmark_items``, an array of (item_id, n_found, n_shingles), to ``docs``.

    ``items``: item_id, text. A document holds an item when at least ``threshold`` of the item's
    distinct five-word shingles (its whole sequence when it is shorter) occur in the document. Items without a word are
    held by nothing; null and empty texts hold nothing. Repeated items are named repeatedly. Items
    are worked off in blocks of about ``block_bytes`` of text, each of which goes to all tasks;
    documents are read whole and are not moved.
    """
    items = items.select("item_id", "text").where(F.col("text").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        rows = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        held = Items([(r[0], r[1].encode("utf-8", "surrogatepass")) for r in rows.orderBy("item_id", "text").collect()], threshold)
        docs = appended(docs, f"_items_{block} array<struct<item_id: long, n_found: int, n_shingles: int>>",
                        _finder(held), ["text"])
    parts = [f"_items_{block}" for block in range(blocks)]
    return docs.withColumn("benchmark_items", F.flatten(F.array(*parts))).drop(*parts)


def _finder(items: Items):
    def work(texts):
        return [[[{"item_id": items.ids[k], "n_found": n, "n_shingles": of} for k, n, of in items.matches((t or "").encode("utf-8", "surrogatepass"))]
                 for t in texts]]

    return lambda: work


def contained(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_found, n_shingles, containment: a row for each document and item it holds."""
    found = flagged(docs.select("doc_id", "text"), items, threshold)
    return found.select("doc_id", F.explode("benchmark_items").alias("i")).select(
        "doc_id", "i.item_id", "i.n_found", "i.n_shingles", (F.col("i.n_found") / F.col("i.n_shingles")).alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    return flagged(docs, items, threshold).where(F.size("benchmark_items") == 0).drop("benchmark_items")
