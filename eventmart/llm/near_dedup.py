"""Operator 7: near-duplicate documents by HyperMinHash.

1. Every text becomes its set of 5-word shingles (64-bit hashes). Each of 192 buckets of hash space keeps the
   smallest hash in it as a HyperMinHash register: leading zeros and 10 mantissa bits. Equal sets (128-bit digest)
   collapse to one class, represented by its smallest doc_id.
2. Empty registers are filled from others by fixed probe orders; 32 bands of 6 registers give the band keys. At a
   similarity of 0.85 a pair shares no band with probability 3e-7.
3. Star links: each member of a band is compared with the band's smallest member. Confirmed links give first
   components.
4. Rest links: bands that still hold several components are cut into blocks; in each pair of blocks the pairs of
   different components whose collision-corrected similarity estimate comes near the threshold are confirmed.
   Pairs within a component add nothing, so large groups of copies cost no pairs. A pair exactly at the threshold is
   lost by the estimate with probability 6e-8 (0.85) or 3e-9 (0.80) at most, for any number of used registers.
5. Links are always confirmed on full shingle sets; components come from star contraction on Spark.

Blocks bound both the documents and the shingles that meet in a task. Only links leave the tasks.

Edge cases: a null text, or one without words, has the empty set and links with nothing; fewer than five words form
one shingle; rows with null doc_id link with nothing and are kept (component null); rows that share a doc_id are one
node; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import shingles
from eventmart.llm.common import components, drop, groups, written

REGISTERS, BANDS, MANTISSA = 192, 32, 10
ROWS = REGISTERS // BANDS
#: Most documents and shingles (on average) of one block.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 400_000
#: Standard deviations by which an estimate may lie below the threshold and still be confirmed: so many that the
#: estimate loses less than the bands do.
MARGIN = 7.0

_WIDTH = 2.0 ** 64 / REGISTERS
_BOUNDS = np.array([(i << 64) // REGISTERS for i in range(REGISTERS)], np.uint64)
_rng = np.random.default_rng(7)
_PROBES = np.array([np.concatenate(([i], _rng.permutation(np.delete(np.arange(REGISTERS), i))))
                    for i in range(REGISTERS)])
_BAND_FACTORS = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_SEEDS = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)


def registers(found: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of hashes; 0 stands for an empty bucket."""
    out = np.zeros(REGISTERS, np.uint16)
    at = np.searchsorted(found, _BOUNDS)
    filled = at < np.append(at[1:], len(found))
    low = (found[at[filled]] - _BOUNDS[filled]).astype(np.float64) / _WIDTH
    fraction, exponent = np.frexp(np.maximum(low, 2.0 ** -61))
    zeros = np.minimum(-exponent, 61)
    out[filled] = 1 + zeros * (1 << MANTISSA) + ((2 * fraction - 1) * (1 << MANTISSA)).astype(np.int64)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """32 signed 64-bit keys; an empty register takes the first filled one of its probe order."""
    if not regs.all():
        regs = regs[_PROBES[np.arange(REGISTERS), (regs[_PROBES] > 0).argmax(axis=1)]]
    with np.errstate(over="ignore"):
        sums = (regs.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
    return shingles.mix(sums ^ _BAND_SEEDS).view(np.int64)


def estimate(regs: np.ndarray, n: int, others: np.ndarray, ns: np.ndarray,
             percent: int = 85) -> tuple[np.ndarray, np.ndarray]:
    """Similarity estimates against ``others``, less the registers expected to agree by chance, and their deviation.

    The deviation is that of pairs whose similarity is ``percent``.
    """
    agree = ((others == regs) & (regs > 0)).sum(axis=1)
    used = np.maximum(((others > 0) | (regs > 0)).sum(axis=1), 1)
    ratio = np.minimum(ns, n) / np.maximum(ns, n)
    chance = 0.169919487159739 * 2.0 ** -MANTISSA * 4 * ratio / (1 + ratio) ** 2 * used
    value = np.clip((agree - chance) / np.maximum(used - chance, 1e-9), 0, 1)
    return value, np.sqrt(percent * (100 - percent) / 1e4 / used)


SIGNATURES = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    """Set size, digest of the set and band keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, keys = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles.shingle_set(text)
                sizes.append(len(found))
                first.append(int(shingles.mix(found).sum(dtype=np.uint64).view(np.int64)))
                second.append(int(shingles.mix(found ^ np.uint64(0xA5A5)).sum(dtype=np.uint64).view(np.int64)))
                keys.append(band_keys(registers(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "d1", "d2", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, SIGNATURES)


SETS = "id long, n long, regs binary, bands binary, shingles binary"


def candidate_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Registers, band keys and full sets of the documents in ``ids`` (id), once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = shingles.shingle_set(text)
                if len(found):
                    regs = registers(found)
                    rows.append((doc_id, len(found), regs.tobytes(), band_keys(regs).tobytes(), found.tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["id", "n", "regs", "bands", "shingles"])

    wanted = docs.select("doc_id", "text").join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    return wanted.mapInArrow(run, SETS)


def _linked(inter: int, a: int, b: int, percent: int) -> bool:
    return 100 * inter >= percent * (a + b - inter)


def _star_check(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["pivot", "block"]):
            ids, sizes, sets = (group.column(k).to_pylist() for k in ("id", "n", "shingles"))
            pivot = group.column("pivot")[0].as_py()
            centre = next((np.frombuffer(s, np.uint64) for i, s in zip(ids, sets, strict=True) if i == pivot), None)
            if centre is None:
                continue
            found = [i for i, n, s in zip(ids, sizes, sets, strict=True)
                     if i != pivot and 100 * min(n, len(centre)) >= percent * max(n, len(centre))
                     and _linked(shingles.overlap(np.frombuffer(s, np.uint64), centre), n, len(centre), percent)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([pivot] * len(found), pa.int64())],
                                             names=["a", "b"])
    return run


def _rest_check(percent: int):
    threshold = percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["key", "low", "high"]):
            cells = group.select(["id", "comp", "n", "block"]).to_pydict()
            ids, comps, n = (np.array(cells[k], np.int64) for k in ("id", "comp", "n"))
            high = np.array(cells["block"]) == group.column("high")[0].as_py()
            both = group.column("low")[0].as_py() == group.column("high")[0].as_py()
            key = group.column("key")[0].as_py()
            regs = np.frombuffer(b"".join(group.column("regs").to_pylist()), np.uint16).reshape(len(ids), REGISTERS)
            bands = np.frombuffer(b"".join(group.column("bands").to_pylist()), np.int64).reshape(len(ids), BANDS)
            sets = group.column("shingles")
            band = int((bands[0] == key).argmax())
            full: dict[int, np.ndarray] = {}
            root = dict.fromkeys(comps.tolist())

            def of(x: int) -> int:
                while root[x] is not None:
                    x = root[x]
                return x

            left, right = [], []
            for i in range(len(ids)):
                others = np.arange(i + 1, len(ids)) if both else np.flatnonzero(high) if not high[i] else []
                if not len(others):
                    continue
                # The first band that a pair shares is the one that judges it.
                others = others[(comps[others] != comps[i]) & (100 * np.minimum(n[others], n[i])
                                                               >= percent * np.maximum(n[others], n[i]))]
                others = others[~(bands[others, :band] == bands[i, :band]).any(axis=1)]
                if not len(others):
                    continue
                value, spread = estimate(regs[i], n[i], regs[others], n[others], percent)
                for j in others[value + MARGIN * spread >= threshold].tolist():
                    a, b = of(int(comps[i])), of(int(comps[j]))
                    if a == b:
                        continue
                    for k in (i, j):
                        if k not in full:
                            full[k] = np.frombuffer(sets[k].as_py(), np.uint64)
                    if _linked(shingles.overlap(full[i], full[j]), int(n[i]), int(n[j]), percent):
                        root[max(a, b)] = min(a, b)
                        left.append(int(ids[i]))
                        right.append(int(ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def _blocks(counted: DataFrame) -> DataFrame:
    """Add ``blocks`` from ``docs`` and ``total`` (shingles) of a group."""
    return counted.withColumn("blocks", F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS),
                                                   F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int"))


def _sorted_groups(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component) and kept of ``docs`` (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    signed, _ = written(signatures(docs), "signatures")
    known = signed.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    members, members_path = written(classes.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")),
                                    "band-members")
    shared, shared_path = written(members.groupBy("key").agg(F.count("*").alias("docs"), F.min("id").alias("pivot"))
                                  .where("docs > 1").drop("docs"), "shared-bands")
    shared_members, sm_path = written(members.join(shared, "key"), "shared-members")
    drop(spark, members_path, shared_path)

    ids = shared_members.select("id").distinct()
    sets, sets_path = written(candidate_sets(docs, ids), "candidate-sets")

    star = shared_members.where("id <> pivot").select("id", "n", "pivot").distinct()
    sized = _blocks(star.groupBy("pivot").agg(F.count("*").alias("docs"), F.sum("n").alias("total")))
    dealt = (star.select("id", "pivot").join(sized.select("pivot", "blocks"), "pivot")
             .select("pivot", F.expr("pmod(xxhash64(id), blocks)").cast("int").alias("block"), "id"))
    dealt = dealt.unionByName(sized.select("pivot", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                                           F.col("pivot").alias("id")))
    star_links, star_path = written(
        _sorted_groups(dealt.join(sets.select("id", "n", "shingles"), "id"), "pivot", "block")
        .mapInArrow(_star_check(percent), "a long, b long"), "star-links")
    first, first_path = components(star_links, "star")

    placed = (shared_members.select("key", "id", "n").join(first.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("comp", F.coalesce("comp", "id")))
    mixed = _blocks(placed.groupBy("key").agg(F.count("*").alias("docs"), F.sum("n").alias("total"),
                                              F.min("comp").alias("low"), F.max("comp").alias("high"))
                    .where("low <> high"))
    blocks = (placed.join(mixed.select("key", "blocks"), "key")
              .withColumn("block", F.expr("pmod(xxhash64(id), blocks)").cast("int"))
              .select("key", "id", "comp", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
              .select("key", "id", "comp", "block", F.least("block", "other").alias("low"),
                      F.greatest("block", "other").alias("high")))
    rest_links, rest_path = written(
        _sorted_groups(blocks.join(sets, "id"), "key", "low", "high")
        .mapInArrow(_rest_check(percent), "a long, b long"), "rest-links")
    linked, _ = components(star_links.unionByName(rest_links), "all")
    drop(spark, star_path, rest_path, first_path, sets_path, sm_path)

    # A class is represented by its smallest doc_id; every copy takes the component of its class.
    named = (known.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
             .join(linked, "node", "left").where("copies > 1 or comp is not null")
             .select("d1", "d2", "n_shingles", F.coalesce("comp", "node").alias("component")))
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component"))
    return (signed.join(named, ["d1", "d2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce(component, F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
