"""Operator 1: token ids as fixed-width bit-packed blocks.

Format: a Parquet table with one row per block of whole documents in ascending doc_id order (null first, ties
by text): ``part`` (partition of the sort), ``seq`` (block within it), ``part_start`` (ids of the partition
before the block), ``doc_ids``, ``doc_ends`` (end of each document within the block) and ``payload``.

Payload, little-endian: magic ``BPK1``, u32 bits, u64 ids, u32 ids per page, u32 pages, u64 offsets[pages + 1]
into the data, then the pages. Within a page, 64 ids fill exactly ``bits`` 64-bit words, so a page unpacks with
a fixed number of vectorised shifts, and any id is found from its page's offset without reading the others.

Edge cases: a null text encodes as an empty one (end id only); an empty table gives no blocks and no rows; a
text of any length stays within one block; repeated rows are encoded each on its own; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import written

#: Ids after which a block is closed, and ids of one page.
BLOCK_IDS = 65_536
PAGE_IDS = 4_096
#: Chunks and words, together, whose ids a worker remembers, and the most characters of one. Both bound its memory.
CACHE = 400_000
CACHED_CHARS = 64

BLOCKS = ("part int, seq int, part_start long, n_ids long, doc_ids array<long>, doc_ends array<long>, "
          "payload binary")


# The tokenizer's own split pattern, spelled out for lower-case Latin-1.
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\t-\\r \x85\xa0{_LETTERS}{_NUMBERS}]+")


# How the tokenizer whose chunks `Encoder` knows prepares and splits a text.
_PREPARED = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed",
     "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def _visible() -> list[str]:
    """The characters that stand for the 256 bytes in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Ids of a text by a public tokenizer, remembered by white-space chunk and by word.

    The tokenizer splits at white space and drops it, so a text's ids are its chunks' ids in a row. A new chunk of
    Latin-1 letters is split by the tokenizer's pattern and its new words go to the tokenizer's model; any other new
    chunk, and a text that spells one of the special tokens, goes to the tokenizer whole. So does every text if the
    vocabulary file prepares or splits texts in another way.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_chunk = spec.get("normalizer") == _PREPARED and spec.get("pre_tokenizer") == _SPLIT and all(
            t["content"].startswith("<|") for t in spec.get("added_tokens", ()))
        self.known: dict[str, bytes] = {}  # a word split once more is itself, so words and chunks share it
        self.visible = _visible()
        self.spelled = [i.to_bytes(4, "little") for i in range(self.size)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _remember(self, part: str, ids: bytes) -> None:
        if len(self.known) < CACHE and len(part) <= CACHED_CHARS:
            self.known[part] = ids

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            spelled = word if word.isascii() and word.isalnum() else "".join(
                self.visible[b] for b in word.encode())
            ids = b"".join([self.spelled[t.id] for t in self.model.tokenize(spelled)])
            self._remember(word, ids)
        return ids

    def _chunk(self, chunk: str, latin: bool) -> bytes:
        if latin or chunk.isascii() and chunk.islower():
            ids = b"".join(map(self._word, _PARTS.findall(chunk)))
        else:
            ids = self._whole(chunk)
        self._remember(chunk, ids)
        return ids

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.by_chunk or "<|" in text:
            return self._whole(text)
        try:
            text.encode("latin-1")
            latin = True
            text = text.lower()  # as the tokenizer does; beyond Latin-1 the rules differ
        except UnicodeEncodeError:
            latin = False
        for space in "\n\t\r\x0b\x0c":
            text = text.replace(space, " ")
        chunks = text.split(" ")
        found = list(map(self.known.get, chunks))
        if None in found:
            for i in [i for i, ids in enumerate(found) if ids is None]:
                found[i] = self._chunk(chunks[i], latin)
        return b"".join(found)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def bits_for(vocabulary: int) -> int:
    return max(1, math.ceil(math.log2(max(2, vocabulary))))


#: Widths of whole machine integers need no shifts; the bytes are the same.
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def _pack_page(ids: np.ndarray, bits: int) -> bytes:
    rows = -(-len(ids) // 64)
    if bits in _WHOLE:
        return ids.astype(_WHOLE[bits]).tobytes() + bytes((rows * 64 - len(ids)) * bits // 8)
    lanes = np.zeros(rows * 64, np.uint64)
    lanes[:len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(rows, 64).T)
    out = np.zeros((bits, rows), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[word] |= lanes[j] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def _unpack_page(data: memoryview, count: int, bits: int) -> np.ndarray:
    if bits in _WHOLE:
        return np.frombuffer(data, _WHOLE[bits], count).astype(np.uint32)
    rows = -(-count // 64)
    packed = np.ascontiguousarray(np.frombuffer(data, "<u8", rows * bits).reshape(rows, bits).T)
    mask = np.uint64((1 << bits) - 1)
    lanes = np.empty((64, rows), np.uint32)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = packed[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (packed[word + 1] << np.uint64(64 - shift))
        lanes[j] = value & mask
    return np.ascontiguousarray(lanes.T).reshape(-1)[:count]


def pack(ids: np.ndarray, bits: int, page_ids: int = PAGE_IDS) -> bytes:
    """The payload of one block. An id that needs more than ``bits`` bits is an error, never cut."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} does not fit {bits} bits")
    pages = [_pack_page(ids[i:i + page_ids], bits) for i in range(0, len(ids), page_ids)]
    offsets = np.cumsum([0, *map(len, pages)]).astype("<u8")
    head = struct.pack("<4sIQII", b"BPK1", bits, len(ids), page_ids, len(pages))
    return b"".join([head, offsets.tobytes(), *pages])


def unpack(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block as uint32; only the pages that hold them are decoded."""
    magic, bits, count, page_ids, n_pages = struct.unpack_from("<4sIQII", payload)
    if magic != b"BPK1":
        raise ValueError("not a block of packed ids")
    stop = count if stop is None else min(stop, count)
    if start >= stop:
        return np.empty(0, np.uint32)
    offsets = np.frombuffer(payload, "<u8", n_pages + 1, 24)
    data = memoryview(payload)[24 + 8 * (n_pages + 1):]
    first, last = start // page_ids, (stop - 1) // page_ids
    found = [_unpack_page(data[int(offsets[p]):int(offsets[p + 1])], min(page_ids, count - p * page_ids), bits)
             for p in range(first, last + 1)]
    return np.concatenate(found)[start - first * page_ids:stop - first * page_ids]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks (schema ``BLOCKS``) of ``docs`` (doc_id, text), each document's ids followed by ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        bits = bits_for(max(enc.size, end_id + 1))
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        names, ends, held, count = [], [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def block() -> pa.RecordBatch:
            payload = pack(np.frombuffer(b"".join(held), "<u4"), bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([count], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                names=["part", "seq", "part_start", "n_ids", "doc_ids", "doc_ends", "payload"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = enc.ids(text) + end
                held.append(ids)
                count += len(ids) // 4
                names.append(doc_id)
                ends.append(count)
                if count >= block_ids:
                    yield block()
                    seq, before = seq + 1, before + count
                    names, ends, held, count = [], [], [], 0
        if names:
            yield block()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, BLOCKS)


def read_documents(blocks: DataFrame) -> DataFrame:
    """Per document, from the blocks' payloads: doc_id, start, n_tokens and ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"]).astype("<u4")
                ends = np.array(row["doc_ends"], np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(ends), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts + row["part_start"]), pa.array(ends - starts),
                     pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)], pa.int64())],
                    names=["part", "doc_id", "in_part", "n_tokens", "ids_crc32"])

    # One row for each partition of the sort.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = sizes.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding "
                                      "and 1 preceding), 0) as before")
    docs = blocks.select("part", "part_start", "doc_ids", "doc_ends", "payload").mapInArrow(
        run, "part int, doc_id long, in_part long, n_tokens long, ids_crc32 long")
    return docs.join(starts, "part").selectExpr("doc_id", "before + in_part as start", "n_tokens", "ids_crc32")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1) -> tuple[DataFrame, str]:
    """Write the blocks to the shared scratch folder; the table read back, and its path."""
    return written(pack_documents(docs, tokenizer, end_id), "token-ids")
