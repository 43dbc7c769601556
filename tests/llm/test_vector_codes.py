import hashlib

import numpy as np
import pytest

from eventmart.llm import vector_codes as vc


def brute(rows, entries=64):
    """The contract, plainly, on Python integers."""
    kept = [(i, x, [int(np.floor(256 * v)) for v in vec]) for i, x, vec in rows
            if vec is not None and all(v is not None and np.isfinite(v) for v in vec)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // 16
    cut = lambda v: [v[p * w:p * w + w] for p in range(16)]
    book = [[cut(v)[p] for _, _, v in kept[:entries]] for p in range(16)]
    best = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book[p]))
    for _ in range(2):
        new = [list(map(list, b)) for b in book]
        for p in range(16):
            groups = {}
            for _, _, v in kept:
                groups.setdefault(best(p, cut(v)[p])[1], []).append(cut(v)[p])
            for k, g in groups.items():
                new[p][k] = [sum(c) // len(g) for c in zip(*g, strict=True)]
        book = new
    found = [(i, x, [best(p, cut(v)[p]) for p in range(16)]) for i, x, v in kept]
    sums = {}
    for _, x, f in found:
        sums[x] = sums.get(x, 0) + sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(c) for b in book for e in b for c in e).encode()).hexdigest()
    return sorted(str((i, x, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), sums[x])) for i, x, f in found), digest


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "z", 1) for i, x, v in rows],
                                 "vec_id long, embedding array<float>, label int, code string, part int")


def coded(spark, rows):
    codes, book = vc.vector_codes(frame(spark, rows))
    got = vc.with_label_error(codes).select("vec_id", "label", "code", "error", "label_error").collect()
    return sorted(str(tuple(r)) for r in got), vc.codebooks_digest(book)


def rows_of(rng, n, length, spread):
    return [(int(i), int(rng.integers(0, 4)), [float(np.float32(v)) for v in rng.normal(0, spread, length)])
            for i in rng.permutation(n)]


@pytest.mark.parametrize(("n", "length", "spread"), [(700, 64, 0.2), (300, 16, 0.01), (150, 48, 40.0), (20, 32, 1.0), (1, 16, 1.0)])
def test_codes_equal_the_plain_way(spark, n, length, spread):
    rows = rows_of(np.random.default_rng(n), n, length, spread)
    assert coded(spark, rows) == brute(rows)


def test_ties_copies_nulls_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = rows_of(rng, 200, 32, 0.1)
    rows += [(5, None, rows[0][2]), (5, 2, rows[1][2]), (None, None, rows[2][2]), (None, 1, rows[3][2])]
    rows += [(1000 + i, 9, [0.25] * 32) for i in range(300)] + [(2000 + i, 1, [0.0] * 32) for i in range(70)]
    rows += [(-3, 1, [0.5] * 32), (-2, 1, [0.5] * 32)]
    odd = [(-10, 1, None), (-11, 1, [float("nan")] * 32), (-12, 1, [None] * 32), (-13, 1, [float("-inf")] + [0.0] * 31)]
    assert coded(spark, rows + odd) == brute(rows)
    assert coded(spark, [*rows, *odd, (3000, 1, [1.0] * 16), (3001, 1, [])]) == brute(rows)  # other lengths go
    assert coded(spark, odd)[0] == [] and coded(spark, [])[0] == []


def test_too_large_components_and_odd_lengths_raise(spark):
    with pytest.raises(ValueError):
        coded(spark, [(1, 1, [0.0] * 17)])
    with pytest.raises(Exception, match="too large"):
        coded(spark, [(1, 1, [1e30] * 16)])


def test_hilbert_keys_walk_one_step_at_a_time():
    for axes, bits in ((2, 4), (3, 3), (4, 2), (1, 5)):
        cells = np.indices([1 << bits] * axes).reshape(axes, -1).T
        keys = vc.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry_and_save_work():
    rng = np.random.default_rng(3)
    points = rng.integers(-60, 60, (16_384, 1, 4))
    entries = points[:64, 0]
    blocks = vc.build_blocks(points)
    listed = vc.shortlists(blocks["low"][0], blocks["high"][0], entries)
    every = ((blocks["points"][0][:, :, None] - entries[None, None]) ** 2).sum(axis=-1)
    code, dist = vc.nearest(blocks["points"][0], listed, entries)
    assert (code == every.argmin(axis=-1)).all() and (dist == every.min(axis=-1)).all()
    assert listed.mean() < 0.5
