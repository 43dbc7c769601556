import zlib

from eventmart.llm import chat, sharding
from tests.llm.cases import TEXTS, empty, frame

TURNS = "conv_id long, turn long, role string, text string, place string, start string, h1 string, _at string"


def brute(rows):
    convs: dict = {}
    for conv, turn, role, text in set(rows):
        convs.setdefault(conv, []).append((turn, role, text))
    low = lambda x: (x is not None, x if x is not None else 0)
    lists = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (low(x[0]), (x[1] is not None, x[1] or ""),
                                                               (x[2] is not None, x[2] or "")))]
             for c, v in convs.items()}
    order = sorted(lists, key=lambda c: (c is None, c or 0))
    kept = [c for c in order if not any(
        len(lists[o]) > len(lists[c]) and lists[o][:len(lists[c])] == lists[c] for o in order)
        and not any(lists[o] == lists[c] for o in order[:order.index(c)])]
    out = []
    for c in kept:
        start = 0
        for k, (role, text) in enumerate(lists[c]):
            piece = f"<|im_start|>{role or 'unknown'}\n{text or ''}<|im_end|>\n" if role != "" else \
                f"<|im_start|>\n{text or ''}<|im_end|>\n"
            out.append((c, k, len(lists[c]), role, start, piece))
            start += len(piece)
    return sorted(out, key=str)


def test_snapshots_collapse(spark):
    rows = []
    for conv in range(60):
        rows += [(conv, t, "user" if t % 2 == 0 else "assistant", f"say {conv % 7} {t}") for t in range(conv % 5 + 1)]
    rows += [(100, 5, "user", "say 1 0"), (100, 9, "assistant", "say 1 1"), (100, 9, "assistant", "say 1 1")]  # other numbering
    rows += [(101, 0, None, None), (102, 0, None, None), (102, 1, "user", None), (103, 0, "", ""), (None, 0, "user", "lost"),
             (104, None, "user", "b"), (104, None, "user", "a"), (105, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame([(*r, *"zzzz") for r in rows], TURNS)
    assert sorted((tuple(r) for r in chat.chat_turns(df).collect()), key=str) == brute(rows)
    assert chat.chat_turns(df.limit(0)).count() == 0


def test_shards_are_contiguous_balanced_and_gapless(spark):
    rows = [*TEXTS, *((1000 + k, "t" * (k * 37 % 500)) for k in range(700))]
    got = sorted((r.asDict() for r in sharding.byte_shards(frame(spark, rows), shards=6).collect()),
                 key=lambda r: (r["shard"], r["slot"]))
    want = sorted(((d is not None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows))
    assert [(r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got] == want
    sizes = [sum(r["size"] for r in got if r["shard"] == s) for s in range(6)]
    largest = max(r["size"] for r in got)
    assert max(abs(s - sum(sizes) / 6) for s in sizes) <= largest
    for s in range(6):
        slots = [r["slot"] for r in got if r["shard"] == s]
        assert slots == list(range(len(slots)))
    assert sharding.byte_shards(empty(spark)).count() == 0
