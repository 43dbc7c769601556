"""Operator 8: quality scores by nearest-neighbour voting in a latent semantic space.

A text is a vector of hashed terms: byte trigrams, trigrams of character classes (which see layout and symbols, not
words) and binned repetition figures. Counts are damped (log), weighted by rarity and projected on the leading
singular vectors of the labelled sample. Every document is compared with all labelled vectors (exact cosines, one
matrix product per block of documents); its ``NEIGHBOURS`` nearest vote with weight cosine ** ``SHARPNESS``, and
each class's votes are scaled back to its share among the labelled rows.

The fit uses at most ``FIT_ROWS`` labelled rows of each class, chosen by a hash of doc_id, so the vectors that go to
the tasks are bounded (2 * FIT_ROWS * RANK floats, and the projection). Every document is scored whole.

Edge cases: null and empty texts have a zero vector and get the share of label 1 among the labelled rows; so does
every text without labelled rows of both classes (0.5 if there are none); of labelled rows equally near at the border of
the neighbourhood, those vote that the partial sort of the fixed row order yields; of several labels of a doc_id the
lowest counts; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import labelled_sample

FIT_ROWS = 2_000
RANK = 64
NEIGHBOURS = 25
SHARPNESS = 6
GRAMS, SHAPES, BINS = 2048, 1024, 160
DIM = GRAMS + SHAPES + BINS
#: Bytes counted at once.
PIECE = 1 << 20

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[c for c in range(256) if c >= 128 or chr(c).islower()]] = ord("a")
_SHAPE[[c for c in range(128) if chr(c).isupper()]] = ord("A")
_SHAPE[[c for c in range(128) if chr(c).isdigit()]] = ord("0")


def _trigrams(codes: np.ndarray, size: int) -> np.ndarray:
    counts = np.zeros(size)
    bits = size.bit_length() - 1
    for at in range(0, max(0, len(codes) - 2), PIECE):
        c = codes[at:at + PIECE + 2].astype(np.uint32)
        h = (c[:-2] | (c[1:-1] << np.uint32(8)) | (c[2:] << np.uint32(16))) * np.uint32(2654435761)
        counts += np.bincount(h >> np.uint32(32 - bits), minlength=size)
    return counts


def _figures(data: bytes) -> list[float]:
    """Shares between 0 and 1: repetition of words and lines, the commonest word, symbols, capitals, long lines."""
    words = data.split()
    if not words:
        return []
    lines = [x for x in data.split(b"\n") if x.strip()]
    runs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    codes = np.frombuffer(data, np.uint8)
    shape = np.bincount(_SHAPE[codes], minlength=256)
    letters = shape[ord("a")] + shape[ord("A")]
    marks = len(codes) - letters - shape[ord("0")] - shape[32] - shape[10]
    return [len(set(words)) / len(words), len(set(lines)) / len(lines), Counter(words).most_common(1)[0][1] / len(words),
            runs / len(words), marks / len(codes), shape[ord("A")] / max(1, letters), shape[ord("0")] / len(codes),
            min(1.0, len(words) / len(lines) / 100), min(1.0, np.log10(len(words)) / 6),
            min(1.0, len(data) / len(words) / 20)]


def counts(text: str | None) -> np.ndarray:
    """Term counts of a text; each repetition figure spreads over the two nearest of its 16 bins."""
    data = (text or "").encode("utf-8", "surrogatepass")
    codes = np.frombuffer(data, np.uint8)
    out = np.zeros(DIM, np.float32)
    out[:GRAMS] = np.log1p(_trigrams(codes, GRAMS))
    out[GRAMS:GRAMS + SHAPES] = np.log1p(_trigrams(_SHAPE[codes], SHAPES))
    scale = float(np.linalg.norm(out)) or 1.0
    out /= scale
    for k, share in enumerate(_figures(data)):
        low, rest = divmod(float(share) * 15, 1)
        at = GRAMS + SHAPES + 16 * k + int(low)
        out[at] += 0.35 * (1 - rest)
        if rest:
            out[at + 1] += 0.35 * rest
    return out


@dataclass
class Space:
    """Projection (with the terms' weights) and the labelled vectors of unit length."""

    projection: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray  # by labelled row: weight of its class
    labels: np.ndarray
    share: float

    def scores(self, texts: list[str | None], block: int = 256) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if not len(self.vectors):
            return out
        for at in range(0, len(texts), block):
            rows = np.stack([counts(t) for t in texts[at:at + block]]) @ self.projection
            size = np.linalg.norm(rows, axis=1)
            cosines = rows / np.maximum(size, 1e-12)[:, None] @ self.vectors.T
            k = min(NEIGHBOURS, cosines.shape[1])
            near = np.argsort(-cosines, axis=1, kind="stable")[:, :k] if cosines.shape[1] <= k else np.argpartition(
                -cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** SHARPNESS * self.votes[near]
            total = weight.sum(axis=1)
            found = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[at:at + block] = np.where((size > 0) & (total > 1e-12), found, self.share)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, rank: int = RANK) -> Space:
    """Space from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality), at most ``rows`` rows of each class."""
    labels = (labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
              .groupBy("doc_id").agg(F.min("label").alias("label")))
    totals = {r["label"]: r["count"] for r in labels.join(docs.select("doc_id"), "doc_id", "left_semi")
              .groupBy("label").count().collect()}
    sample = labelled_sample(docs, labels.where("label = 0"), rows).unionByName(
        labelled_sample(docs, labels.where("label = 1"), rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [counts(t).astype(np.float16).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32()),
                                              pa.array(vectors, pa.binary())], names=["doc_id", "label", "vector"])

    got = sample.repartition(F.xxhash64("doc_id")).mapInArrow(run, "doc_id long, label int, vector binary").collect()
    got.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["label"], bytes(r["vector"])))
    n = sum(totals.values())
    share = totals.get(1, 0) / n if n else 0.5
    empty = Space(np.zeros((DIM, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), np.zeros(0), share)
    if len(totals) < 2:
        return empty
    labels = np.array([r["label"] for r in got])
    x = np.stack([np.frombuffer(r["vector"], np.float16) for r in got]).astype(np.float32)
    rarity = np.log((len(x) + 1) / ((x > 0).sum(axis=0) + 1)) + 1
    rarity[GRAMS + SHAPES:] = 1
    weighted = x * rarity.astype(np.float32)
    rank = min(rank, *weighted.shape)
    basis = np.random.default_rng(8).standard_normal((DIM, rank + 16)).astype(np.float32)
    for _ in range(4):  # subspace iteration towards the leading singular vectors
        basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
    _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
    axes = (basis @ right.T)[:, :rank]
    projection = (rarity[:, None] * axes).astype(np.float32)
    vectors = x @ projection
    size = np.linalg.norm(vectors, axis=1)
    used = size > 0
    vectors = (vectors[used] / size[used, None]).astype(np.float32)
    sampled = Counter(labels.tolist())
    votes = np.array([totals[y] / sampled[y] for y in labels.tolist()])[used]
    return Space(projection, vectors, votes, labels[used].astype(float), share)


def score_documents(docs: DataFrame, space: Space) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(shared.value.scores(batch.column(1).to_pylist()))],
                names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
