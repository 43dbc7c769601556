"""Operator 6: best-fit packing into fixed-size sequences by a configuration linear program.

Spark cuts documents into pieces and counts them by length; the histogram has at most ``size`` counts, whatever
the input. On it the driver solves the covering program over configurations (multisets of lengths that fit one
sequence): multiplicative weights raise the price of lengths that lag behind, and a knapsack dynamic program finds
the configuration of highest price. The solution is rounded down to whole configurations, and what is left goes
best-fit, longest first, also by counts. Spark then hands every piece, by its rank among the pieces of its length,
its sequence and offset.

Edge cases: a null text is an empty one (its end id only); an empty table gives no rows; only documents longer than
``size`` are cut, into full pieces and a rest; repeated rows are packed each on its own; null doc_ids are kept;
other columns are ignored. Equal lengths are interchangeable: which of them meets which is not defined, the number
of sequences is.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import written
from eventmart.llm.tokens import encoder

#: Steps of the multiplicative weights, and how sharply prices react to lag.
STEPS = 400
SHARPNESS = 12.0

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, place long"


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``size`` tokens; ``place`` counts the pieces of a length within the partition ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = enc.ids(text) + end
                total = len(ids) // 4
                for k, at in enumerate(range(0, total, size)):
                    length = min(size, total - at)
                    out.append((doc_id, k, at, length, zlib.crc32(ids[4 * at:4 * (at + length)]), part,
                                int(seen[length])))
                    seen[length] += 1
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def knapsack(prices: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Counts per length of the configuration of highest price that fits ``size`` (lengths ascending)."""
    best = np.zeros(size + 1)
    last = np.full(size + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for room in range(int(lengths[0]), size + 1):
        value = best[room - lengths[:fits[room]]] + prices[:fits[room]]
        k = int(value.argmax())
        best[room], last[room] = value[k], k
    counts = np.zeros(len(lengths), np.int64)
    room = size
    while last[room] >= 0:
        counts[last[room]] += 1
        room -= int(lengths[last[room]])
    return counts


def configurations(lengths: np.ndarray, counts: np.ndarray, size: int, steps: int = STEPS):
    """Fractional solution of the configuration program: (counts per length, amount), never over any count."""
    covered = np.zeros(len(lengths))
    found: dict[bytes, list] = {}
    for _ in range(steps):
        share = covered / counts
        prices = np.exp(-SHARPNESS * (share - share.min()) / max(share.max(), 1e-9)) / counts
        # Filled space decides between configurations of nearly equal price.
        prices = prices / prices.max() + 1e-3 * lengths / size
        config = knapsack(prices, lengths, size)
        config = np.minimum(config, counts)
        used = config > 0
        amount = float((counts[used] / config[used]).min()) / 8
        covered += amount * config
        found.setdefault(config.tobytes(), [config, 0.0])[1] += amount
    scale = 1 / max(1e-9, float((covered / counts).max()))
    return [(config, amount * scale) for config, amount in found.values()]


def best_fit(lengths: np.ndarray, counts: np.ndarray, size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing by counts: (configuration, number of sequences); equal sequences stay together."""
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    rooms: list[int] = []

    def put(room: int, config: list[tuple[int, int]], n: int) -> None:
        if n:
            if room not in open_:
                bisect.insort(rooms, room)
            open_.setdefault(room, []).append((config, n))

    for length, left in sorted(zip(lengths.tolist(), counts.tolist(), strict=True), reverse=True):
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                config, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, config, n = size, [], -(-left // (size // length))
            each = room // length
            full = min(n, left // each)
            put(room - each * length, [*config, (length, each)], full)
            left -= full * each
            if full < n:
                if left:
                    put(room - left * length, [*config, (length, left)], 1)
                    put(room, config, n - full - 1) if config else None
                    left = 0
                elif config:
                    put(room, config, n - full)
    return [group for groups in open_.values() for group in groups]


def plan(lengths: np.ndarray, counts: np.ndarray, size: int, steps: int = STEPS):
    """(configuration, number of sequences) that use exactly ``counts`` pieces of each length."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    order = np.argsort(lengths)
    lengths, counts = lengths[order], counts[order]
    chosen, left = [], counts.copy()
    if len(lengths):
        for config, amount in sorted(configurations(lengths, counts, size, steps), key=lambda x: -x[1]):
            used = config > 0
            n = int(min(np.floor(amount), (left[used] // config[used]).min()))
            if n and int(config @ lengths) >= size - int(lengths[0]):  # leave gaps that pieces could fill to best fit
                chosen.append(([(int(a), int(c)) for a, c in zip(lengths[used], config[used], strict=True)], n))
                left -= n * config
    rest = left > 0
    return chosen + best_fit(lengths[rest], left[rest], size)


def runs(chosen) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, pieces in each sequence, offset), ascending by rank."""
    cursor: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for config, n in chosen:
        offset = 0
        for length, each in config:
            first = cursor.get(length, 0)
            out.setdefault(length, []).append((first, sequence, each, offset))
            cursor[length] = first + n * each
            offset += each * length
        sequence += n
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs`` (doc_id, text)."""
    cut, _ = written(pieces(docs, tokenizer, size, end_id), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``size`` rows
    where = runs(plan([r["length"] for r in histogram], [r["n"] for r in histogram], size))
    earlier = by_part.selectExpr(
        "part", "length", "coalesce(sum(n) over (partition by length order by part rows between unbounded preceding "
        "and 1 preceding), 0) as earlier")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                at = np.flatnonzero(length == one)
                table = where[int(one)]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                turn, slot = np.divmod(rank[at] - row[:, 0], row[:, 2])
                sequence[at], offset[at] = row[:, 1] + turn, row[:, 3] + slot * one
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in names[:3]), batch.column("length").cast(pa.int64()),
                 batch.column("ids_crc32"), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    ranked = cut.join(earlier, ["part", "length"]).selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "earlier + place as rank")
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")
