"""Operator 11: product-quantised vector codes from Hilbert-sorted flat blocks and exact integer kernels.

Components become integers floor(256 * x). A chunk of up to ``CHUNK`` vectors, as its partition holds them, is one row
of the block table: for each of the parts its points are sorted along a Hilbert curve and cut into flat blocks, and
each block keeps its box (least and greatest components) and its sum. A round compares the boxes with the codebook: an
entry whose least distance to a box exceeds the smallest of the entries' greatest distances can't be nearest to any
point in it. What remains is the block's shortlist. A shortlist of one takes the block's stored sum and reads no
point; for longer ones an integer kernel measures the points against the shortlist. All is exact: the order and the
blocks decide the work, not the result.

Nothing is shuffled but one row for each entry and task in a round, and the errors summed by label at the end; a vector
stays in its chunk. The codebook (parts x entries) is the only thing that the driver holds.

Edge cases: vectors that are null or hold null or non-finite components are dropped, and so are those of another length
than the first kept one (by vec_id), as they have other parts; equal vec_ids are ordered by their components and null ones
come last; repeated rows are coded each; fewer kept vectors than entries give a smaller codebook; null labels are one
label; other columns are ignored; no rows give none. A length that the parts don't divide, and components too large for
exact 64-bit distances (from about 2^26 / 256 in 4-component parts), raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import drop, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a chunk and points of a block.
CHUNK, BLOCK = 16_384, 16


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (unsigned, ``bits`` each; columns x bits <= 64)."""
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q, below = one << np.uint64(level), (one << np.uint64(level)) - one
        for axis in x:
            high = (axis & q) != 0
            swap = np.where(high, 0, (x[0] ^ axis) & below).astype(np.uint64)
            axis ^= swap
            x[0] ^= np.where(high, below, swap)
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & one, (one << np.uint64(level)) - one, 0).astype(np.uint64)
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << one) | ((axis >> np.uint64(bit)) & one)
    return key


def _hilbert_order(points: np.ndarray) -> np.ndarray:
    axes = points[:, :32]
    bits = max(1, min(8, 64 // max(axes.shape[1], 1)))
    low = axes.min(axis=0)
    spread = np.maximum(axes.max(axis=0) - low, 1)
    return np.argsort(hilbert_keys((axes - low) * ((1 << bits) - 1) // spread, bits), kind="stable")


def quantized(vectors: np.ndarray, limit: float) -> np.ndarray:
    """floor(256 * x) of (n, length) numbers that stay below ``limit``."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if np.abs(scaled).max(initial=0) >= limit:
        raise ValueError("a component is too large for exact 64-bit distances")
    return scaled.astype(np.int64)


def _limit(width: int, entries: int) -> float:
    """Components below this keep distance * entries + entry within 63 bits."""
    return (2 ** 60 / (width * entries)) ** 0.5


def build_blocks(points: np.ndarray, size: int = BLOCK) -> dict[str, np.ndarray]:
    """Blocks of (n, parts, width) integers: order, points (sorted, the last block filled up), low, high, sums, counts."""
    n, parts, width = points.shape
    blocks = -(-n // size)
    order = np.stack([_hilbert_order(points[:, p]) for p in range(parts)])
    laid = np.take_along_axis(points.transpose(1, 0, 2), order[:, :, None], axis=1)
    starts = np.arange(0, n, size)
    fill = np.repeat(laid[:, -1:], blocks * size - n, axis=1)
    return {"order": order, "points": np.concatenate([laid, fill], axis=1).reshape(parts, blocks, size, width),
            "low": np.minimum.reduceat(laid, starts, axis=1), "high": np.maximum.reduceat(laid, starts, axis=1),
            "sums": np.add.reduceat(laid, starts, axis=1), "counts": np.minimum(size, n - starts)}


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(blocks, entries) booleans: the entries that can be nearest to some point of the block's box, ties included."""
    e, lo, hi = entries[None], low[:, None], high[:, None]
    least = (np.maximum(np.maximum(lo - e, e - hi), 0) ** 2).sum(axis=-1)
    most = (np.maximum(np.abs(e - lo), np.abs(hi - e)) ** 2).sum(axis=-1)
    return least <= most.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, listed: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest listed entry (ties: the lower) and its squared distance for (blocks, size, width) points."""
    block, entry = np.nonzero(listed)
    k = np.int64(len(entries))
    gap = points[block] - entries[entry][:, None]
    keys = np.einsum("psw,psw->ps", gap, gap) * k + entry[:, None]
    firsts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    best = np.minimum.reduceat(keys, firsts, axis=0)
    return best % k, best // k


def block_sums(blocks: dict[str, np.ndarray], codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (parts, entries) and sums (parts, entries, width) of the points nearest to each entry."""
    parts, k, width = codebook.shape
    counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
    size = blocks["points"].shape[2]
    for p in range(parts):
        listed = shortlists(blocks["low"][p], blocks["high"][p], codebook[p])
        alone = listed.sum(axis=1) == 1
        only = listed[alone].argmax(axis=1)
        np.add.at(counts[p], only, blocks["counts"][alone])
        np.add.at(sums[p], only, blocks["sums"][p][alone])  # whole blocks: none of their points is read
        if not alone.all():
            there = np.arange(size)[None] < blocks["counts"][~alone][:, None]  # not what fills up the last block
            points = blocks["points"][p][~alone]
            codes = nearest(points, listed[~alone], codebook[p])[0][there]
            counts[p] += np.bincount(codes, minlength=k)
            for j, axis in enumerate(points[there].T):  # exact in doubles: a chunk's sums stay below 2 ** 53
                sums[p, :, j] += np.bincount(codes, weights=axis, minlength=k).astype(np.int64)
    return counts, sums


def encode(blocks: dict[str, np.ndarray], codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, parts) and squared errors (n), in the order that the points came in."""
    parts, n = blocks["order"].shape
    codes, error = np.empty((n, parts), np.int64), np.zeros(n, np.int64)
    for p in range(parts):
        listed = shortlists(blocks["low"][p], blocks["high"][p], codebook[p])
        code, dist = nearest(blocks["points"][p], listed, codebook[p])
        at = blocks["order"][p]
        codes[at, p] = code.reshape(-1)[:n]
        error[at] += dist.reshape(-1)[:n]
    return codes, error


# --- the block table: one row for each chunk ---------------------------------------------------------------------

_ARRAYS = ("order", "points", "low", "high", "sums")


def _packed(points: np.ndarray) -> dict:
    blocks = build_blocks(points)
    narrow = "int16" if max(-points.min(), points.max()) < 2 ** 15 else "int32"
    kinds = {"order": "uint16", "points": narrow, "low": narrow, "high": narrow, "sums": "int64"}
    return {"kind": narrow} | {k: blocks[k].astype(kinds[k]).tobytes() for k in _ARRAYS}


def _unpacked(row: dict, parts: int, width: int) -> dict[str, np.ndarray]:
    n = len(row["ids"])
    size, blocks = BLOCK, -(-n // BLOCK)
    shapes = {"order": (parts, n), "points": (parts, blocks, size, width), "sums": (parts, blocks, width),
              "low": (parts, blocks, width), "high": (parts, blocks, width)}
    kinds = {"order": "uint16", "sums": "int64"}
    out = {k: np.frombuffer(row[k], kinds.get(k, row["kind"])).reshape(shapes[k]).astype(np.int64) for k in _ARRAYS}
    return out | {"counts": np.minimum(size, n - np.arange(blocks) * size)}


def _chunks(length: int, parts: int, limit: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            flat = t.column("vector").combine_chunks()
            vectors = np.asarray(flat.flatten()).reshape(t.num_rows, length)
            packed = _packed(quantized(vectors, limit).reshape(t.num_rows, parts, length // parts))
            lists = {c: pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column(c).combine_chunks())
                     for c in ("ids", "labels")}
            return pa.RecordBatch.from_pydict(lists | {k: [v] for k, v in packed.items()})

        count = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, CHUNK - count)
                held.append(part)
                count, at = count + part.num_rows, at + part.num_rows
                if count == CHUNK:
                    yield emit()
                    held, count = [], 0
        if count:
            yield emit()
    return rows


def _sums_of(codebook: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = codebook.shape
        counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                n, s = block_sums(_unpacked(batch.slice(i, 1).to_pylist()[0], parts, width), codebook)
                counts += n
                sums += s
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()),
                                          "n": pa.array(counts[p, e])}
                                         | {f"s{j}": pa.array(sums[p, e, j]) for j in range(width)})
    return rows


def _codes_of(codebook: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = codebook.shape
        digits = np.array([f"{i:02x}".encode() for i in range(256)])
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                codes, error = encode(_unpacked(one.to_pylist()[0], parts, width), codebook)
                text = np.ascontiguousarray(digits[codes]).view(f"S{2 * parts}")[:, 0].astype(str)
                yield pa.RecordBatch.from_arrays(
                    [one.column("ids").flatten(), one.column("labels").flatten(), pa.array(text), pa.array(error)],
                    ["vec_id", "label", "code", "error"])
    return rows


def codebooks_digest(codebook: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebook.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) for each kept row of ``vectors``, and the codebook (parts, entries, width).

    At most 256 entries, as a code has two hex digits for each part.
    """
    spark = vectors.sparkSession
    label_type = dict(vectors.dtypes)["label"]
    double = F.col(vector).cast("array<double>")
    kept = (vectors.select(F.col("vec_id").cast("long").alias("ids"), F.col("label").alias("labels"), double.alias("vector"))
            .where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)
                                                           | (F.abs(x) == float("inf")))))
    first = kept.orderBy(F.col("ids").asc_nulls_last(), "vector").select("vector").limit(1).collect()
    length = len(first[0]["vector"]) if first else 0
    if length % parts or not 0 < entries <= 256:
        raise ValueError(f"{length} components can't be cut into {parts} equal parts, or not 1 to 256 entries")
    out = f"vec_id long, label {label_type}, code string, error long"
    if not length:
        return spark.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64)
    kept = kept.where(F.size("vector") == length)
    start = kept.orderBy(F.col("ids").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    width = length // parts
    limit = _limit(width, entries)
    first = quantized(np.array([r["vector"] for r in start]), limit).reshape(len(start), parts, width)
    codebook = first.transpose(1, 0, 2).copy()

    schema = f"ids array<long>, labels array<{label_type}>, kind string, " + ", ".join(f"{c} binary" for c in _ARRAYS)
    blocks, path = written(kept.mapInArrow(_chunks(length, parts, limit), schema), "vector-blocks")
    summed = "part int, entry int, n long, " + ", ".join(f"s{j} long" for j in range(width))
    for _ in range(rounds):
        total = (blocks.mapInArrow(_sums_of(codebook), summed).groupBy("part", "entry")
                 .agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)]))
        for row in total.collect():  # at most one row for each entry of the codebook
            codebook[row["part"], row["entry"]] = [row[f"s{j}"] // row["n"] for j in range(width)]
    codes, _ = written(blocks.mapInArrow(_codes_of(codebook), out), "vector-codes")
    drop(spark, path)
    return codes, codebook


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error summed over the rows of a label. The sums are written first, so that AQE can
    broadcast them or split a label of many rows."""
    sums, _ = written(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
