"""Operator 2: benchmark decontamination by SimHash of item-sized windows.

Words are runs of characters other than white space and ASCII punctuation, A-Z in lower case; a shingle is five
words, weighted by its rarity among the benchmark items. For each item, a window of as many words slides over a
document. Three steps, each losing nothing that the next one needs:

1. Only windows are kept whose shingles found in the item weigh at least the threshold of the item, which any
   confirmed window must (one lookup per shingle of the corpus in the items' sorted shingles).
2. The window's 64-bit SimHash is looked up among the items of its size in a multi-index: fingerprints are cut into
   radius + 1 blocks, so two within the radius agree on one block at least.
3. Candidates are confirmed by the weighted Jaccard similarity of the shingle sets, 0.8 or more.

The items reach the tasks in chunks of at most ``CHUNK`` items, so what is broadcast has a fixed bound; more items
mean more passes.

Edge cases: items with fewer than five words match only documents whose words are exactly theirs; items and
documents without words match nothing, nor do rows with null text; a document shorter than an item is one window;
of equal windows the first is reported; repeated rows give repeated results; empty tables give no rows; other
columns are ignored by `matches` and kept by `clean`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from eventmart.llm import shingles
from eventmart.llm.common import drop, written

CHUNK = 20_000
THRESHOLD = 0.8
#: Two texts of similarity 0.8 differ in about 10 of 64 bits (deviation 3).
RADIUS = 24
N = 5

_SEPARATORS = bytes.maketrans(bytes(c for c in range(33, 127) if not chr(c).isalnum()),
                              b" " * sum(not chr(c).isalnum() for c in range(33, 127)))
_BITS = np.arange(64, dtype=np.uint64)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SEPARATORS).split()


class HammingIndex:
    """All fingerprints within ``radius`` of a query, by exact lookups of radius + 1 blocks of bits."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        cuts = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.tables = []
        for shift, mask in self.blocks:
            table: dict[int, list[int]] = {}
            for i, value in enumerate(((prints >> shift) & mask).tolist()):
                table.setdefault(value, []).append(i)
            self.tables.append({k: np.array(v) for k, v in table.items()})

    def near(self, one: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """Places of the fingerprints within the radius, and their distances."""
        found = [t[v] for t, (shift, mask) in zip(self.tables, self.blocks, strict=True)
                 if (v := int((one >> shift) & mask)) in t]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.unique(np.concatenate(found))
        distance = np.bitwise_count(self.prints[at] ^ one).astype(np.int64)
        near = distance <= self.radius
        return at[near], distance[near]


class Items:
    """The shingles, weights and fingerprints of benchmark items (item_id, text)."""

    def __init__(self, rows: list[tuple[int | None, str | None]], rarity: tuple[np.ndarray, np.ndarray], unseen: float,
                 threshold: float = THRESHOLD, radius: int = RADIUS):
        self.threshold, self.known, self.unseen = threshold, rarity, unseen
        self.ids, self.sizes, sequences = [], [], []
        self.whole: dict[int, list[int | None]] = {}
        for item_id, text in rows:
            found = tokens(text)
            if len(found) >= N:
                self.ids.append(item_id)
                self.sizes.append(len(found))
                sequences.append(shingles.hashes(found, N))
            elif found:
                self.whole.setdefault(int(shingles.hashes(found, N)[0]), []).append(item_id)
        self.sets = [np.unique(s) for s in sequences]
        self.weights = [self.weight(s) for s in self.sets]
        self.totals = [float(w.sum()) for w in self.weights]
        prints = np.array([self.fingerprints(s, len(s))[0] for s in sequences], np.uint64)
        self.by_size = {}
        for size in set(self.sizes):
            at = np.flatnonzero(np.array(self.sizes) == size)
            self.by_size[size] = (at, HammingIndex(prints[at], radius))
        owners = np.concatenate([np.full(len(s), i) for i, s in enumerate(self.sets)] or [np.empty(0, np.int64)])
        grams = np.concatenate(self.sets or [np.empty(0, np.uint64)])
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.owners = np.split(owners[order], first[1:]) if len(self.grams) else []

    def weight(self, grams: np.ndarray) -> np.ndarray:
        """1 + log((items + 1) / (items with the shingle + 1)); ``unseen`` for shingles of no item."""
        known, weights = self.known
        if not len(known):
            return np.full(len(grams), self.unseen)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        return np.where(known[at] == grams, weights[at], self.unseen)

    def fingerprints(self, grams: np.ndarray, width: int) -> np.ndarray:
        """SimHash of every run of ``width`` shingles; each votes alike, so that no chunk of items changes a fingerprint."""
        signs = ((grams[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1
        sums = np.zeros((len(grams) + 1, 64), np.int32)
        np.cumsum(signs, axis=0, out=sums[1:])
        votes = sums[width:] - sums[:-width]
        return ((votes > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item and a sorted set of shingles. Shingles that the item does not hold weigh as
        those of no item, so that the other items of a chunk don't count."""
        own = self.sets[item]
        at = np.minimum(np.searchsorted(own, window), len(own) - 1)
        shared = own[at] == window
        inside = float(self.weights[item][at[shared]].sum())
        return inside / (self.totals[item] + self.unseen * int(np.count_nonzero(~shared)))

    def search(self, text: str | None, first_only: bool = False) -> list[tuple]:
        """(item_id, first word, words, distance, similarity) of each item found in ``text``."""
        found = tokens(text)
        if not found:
            return []
        grams = shingles.hashes(found, N)
        if len(found) < N:
            return [(i, 0, len(found), 0, 1.0) for i in self.whole.get(int(grams[0]), [])]
        if not len(self.grams):
            return []
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        hits = np.flatnonzero(self.grams[at] == grams)
        if not len(hits):
            return []
        places: dict[int, list[int]] = {}
        for hit in hits.tolist():
            for item in self.owners[at[hit]].tolist():
                places.setdefault(item, []).append(hit)
        best: dict[int, tuple] = {}
        for item, own in places.items():
            width = min(self.sizes[item] - N + 1, len(grams))
            for start in self._starts(item, np.array(own), grams, width):
                self._judge(grams, start, width, self.sizes[item], best)
                if best and first_only:
                    return [next(iter(best.values()))]
        return [best[k] for k in sorted(best)]

    def _starts(self, item: int, hits: np.ndarray, grams: np.ndarray, width: int) -> list[int]:
        """Windows whose hits weigh at least the threshold of the item (repeated shingles only add to them)."""
        sums = np.concatenate(([0.0], np.cumsum(self.weight(grams[hits]))))
        starts = np.unique(np.concatenate([hits, hits - width + 1]).clip(0, len(grams) - width))
        low, high = np.searchsorted(hits, starts), np.searchsorted(hits, starts + width)
        return starts[sums[high] - sums[low] >= self.threshold * self.totals[item] - 1e-9].tolist()

    def _judge(self, grams: np.ndarray, start: int, width: int, size: int, best: dict[int, tuple]) -> None:
        one = grams[start:start + width]
        at, index = self.by_size[size]
        near, distances = index.near(self.fingerprints(one, width)[0])
        window = np.unique(one)
        for place, distance in zip(at[near].tolist(), distances.tolist(), strict=True):
            value = self.similarity(place, window)
            if value >= self.threshold and (place not in best or value > best[place][4]):
                best[place] = (self.ids[place], start, width + N - 1, distance, round(value, 6))


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, gram): each item's distinct shingles, and one row without a shingle for the item itself."""
    for batch in batches:
        for text, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = tokens(text)
            if len(found) >= N:
                grams = np.unique(shingles.hashes(found, N)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams) + 1, chunk), pa.int32()), pa.array([None, *grams.tolist()], pa.int64())],
                    names=["chunk", "gram"])


def item_chunks(benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS,
                chunk: int = CHUNK) -> Iterator[Items]:
    """The items in chunks of about ``chunk``, dealt by a hash of the item. Rarity is that among all items."""
    spark = benchmark.sparkSession
    total = benchmark.count()
    chunks = max(1, -(-total // chunk))
    dealt = benchmark.select("item_id", "text", F.expr(f"cast(pmod(xxhash64(item_id, text), {chunks}) as int)").alias("chunk"))
    held, held_path = written(dealt.select("text", "chunk").mapInArrow(_held, "chunk int, gram long"), "item-shingles")
    counts, counts_path = written(held.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "shingle-counts")
    items = (counts.where("gram is null").first() or {"n": 0})["n"]
    for k in range(chunks):
        rows = sorted(((r["item_id"], r["text"]) for r in dealt.where(F.col("chunk") == k).collect()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        own = held.where((F.col("chunk") == k) & F.col("gram").isNotNull()).select("gram").distinct()
        known = own.join(counts, "gram").toArrow()
        grams, n = (known.column(c).to_numpy() for c in ("gram", "n"))
        grams = grams.view(np.uint64)
        order = np.argsort(grams)
        rarity = (grams[order], 1 + np.log((items + 1) / (n[order] + 1)))
        yield Items(rows, rarity, 1 + math.log(items + 1), threshold, radius)
    drop(spark, held_path, counts_path)


MATCHES = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS,
            chunk: int = CHUNK) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text) and item of ``benchmark`` found in it: its best window."""
    spark = docs.sparkSession
    result = None
    for items in item_chunks(benchmark, threshold, radius, chunk):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(doc_id, *found)
                        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                        for found in shared.value.search(text)]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=re.findall(r"(\w+) \w+,?", MATCHES))

        part = docs.select("doc_id", "text").mapInArrow(run, MATCHES)
        result = part if result is None else result.unionByName(part)
    return result


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS,
          chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs`` in which no item of ``benchmark`` is found, with all their columns."""
    for items in item_chunks(benchmark, threshold, radius, chunk):
        docs = docs.where(~_dirty(docs.sparkSession.sparkContext.broadcast(items)))
    return docs


def _dirty(shared: Broadcast) -> Column:
    @F.pandas_udf(BooleanType())
    def dirty(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(shared.value.search(t, first_only=True)) for t in texts], dtype=bool)

    return dirty("text")
