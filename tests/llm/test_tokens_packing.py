import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmart.llm import packing, tokens
from eventmart.llm.common import written
from eventmart.llm.queries import tokenizer_path
from tests.llm.cases import TEXTS, empty, frame


def reference_ids(text):
    enc = tokens.encoder(tokenizer_path())
    return enc.tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("alphabet", [[chr(i) for i in range(256)], list("'sStTrevmldLD a1²µß\x85\xa0"),
                                      list("aé́Σσςİ 　汉😀'ſK"), ["<|endoftext|>", "<|", " ", "a", "I'LL"]])
def test_encoder_equals_the_tokenizer(alphabet):
    enc, rng = tokens.encoder(tokenizer_path()), random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == reference_ids(text), repr(text)


def test_remembered_chunks_and_words_are_bounded_together_in_number_and_length(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 100)
    monkeypatch.setattr(tokens, "CACHED_CHARS", 16, raising=False)
    enc, rng = tokens.Encoder(tokenizer_path()), random.Random(7)
    started = {k: len(v) for k, v in vars(enc).items() if isinstance(v, dict)}
    for _ in range(300):
        text = " ".join("".join(rng.choice("abcé'1.") for _ in range(rng.choice((1, 3, 12, 40)))) for _ in range(8))
        for _ in range(2):  # new, then partly remembered
            assert np.frombuffer(enc.ids(text), "<u4").tolist() == reference_ids(text), repr(text)
    remembered = [v for k, v in vars(enc).items() if k in started and len(v) > started[k]]
    assert 0 < sum(map(len, remembered)) <= 100
    assert all(len(part) <= 16 for cache in remembered for part in cache)


def test_other_vocabularies_are_encoded_whole():
    import public_tokenizers
    enc, rng = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(6)
    assert not enc.by_chunk and tokens.encoder(tokenizer_path()).by_chunk
    for _ in range(800):
        text = "".join(rng.choice(" aAbB'sé\n\t12<|") for _ in range(rng.randint(0, 30)))
        want = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == want, repr(text)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2 ** 32 - 1), max_size=700), st.integers(0, 700), st.integers(0, 700))
def test_blocks_round_trip_and_open_anywhere(bits, values, a, b):
    ids = np.array(values, np.uint64).astype(np.uint32) & np.uint32((1 << bits) - 1)
    payload = tokens.pack(ids, bits, page_ids=128)
    assert tokens.unpack(payload).tolist() == ids.tolist()
    assert tokens.unpack(payload, min(a, b), max(a, b)).tolist() == ids.tolist()[min(a, b):max(a, b)]
    assert len(payload) >= len(ids) * bits / 8


def test_too_large_an_id_is_an_error():
    with pytest.raises(ValueError):
        tokens.pack(np.array([1 << 16], np.uint32), 16)


def test_token_table_round_trip(spark):
    blocks, _ = written(tokens.pack_documents(frame(spark), tokenizer_path(), block_ids=300), "test-blocks")
    got = [tuple(r) for r in tokens.read_documents(blocks).orderBy("start").collect()]
    want, start = [], 0
    for doc_id, text in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*reference_ids(text), 1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    assert tokens.read_documents(tokens.pack_documents(empty(spark), tokenizer_path())).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=20))
def test_plan_uses_every_piece_once_and_fits(histogram):
    chosen = packing.plan(list(histogram), list(histogram.values()), 64, steps=40)
    used: dict[int, int] = {}
    for config, n in chosen:
        assert n > 0 and sum(length * each for length, each in config) <= 64
        for length, each in config:
            used[length] = used.get(length, 0) + n * each
    assert used == histogram


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(2)
    lengths, counts = np.unique(np.clip(rng.lognormal(5.5, 1, 20_000).astype(int), 1, 2048), return_counts=True)
    sequences = sum(n for _, n in packing.plan(lengths, counts, 2048))
    assert sequences <= 1.002 * int(lengths @ counts) / 2048 + 1


def test_packing_awkward_documents(spark):
    got = [r.asDict() for r in packing.pack(frame(spark), tokenizer_path(), size=256).collect()]
    want = []
    for doc_id, text in TEXTS:
        ids = np.array([*reference_ids(text), 0], "<u4")
        want += [(doc_id, k, at, len(ids[at:at + 256]), zlib.crc32(ids[at:at + 256].tobytes()))
                 for k, at in enumerate(range(0, len(ids), 256))]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=key) == sorted(
        want, key=key)
    by_sequence: dict[int, list] = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0
