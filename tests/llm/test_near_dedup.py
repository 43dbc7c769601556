import math

import numpy as np

from eventmart.llm import near_dedup, shingles
from eventmart.llm.common import components
from tests.llm.cases import TEXTS, babble, empty, frame, words


def brute(rows, percent):
    sets = []
    for _, text in rows:
        w = [x.lower() for x in words(text)]
        sets.append(frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(
            tuple(w[i:i + 5]) for i in range(len(w) - 4)))
    nodes = {d: d for d, _ in rows if d is not None}

    def root(x):
        while nodes[x] != x:
            x = nodes[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and (
                    100 * len(a & b) >= percent * len(a | b)):
                x, y = root(rows[i][0]), root(rows[j][0])
                nodes[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else root(d), d is None or root(d) == d)
                   for (d, _), s in zip(rows, sets, strict=True)), key=str)


def near_copies():
    rng = np.random.default_rng(1)
    rows = []
    for group in range(12):
        base = babble(rng, int(rng.integers(6, 160)))
        for _ in range(int(rng.integers(1, 14))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = f"new{int(rng.integers(10_000))}"
            rows.append((int(rng.permutation(100_000)[0]) * 100 + len(rows) % 100, " ".join(copy)))
    common = babble(rng, 12)
    rows += [(10 ** 8 + k, " ".join([*babble(rng, 30), *common])) for k in range(40)]
    return rows


def test_components_match_brute_force(spark):
    rows = near_copies()
    for percent in (80, 85):
        got = near_dedup.near_duplicates(frame(spark, rows), percent).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(rows, percent)


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 3)
    rows = near_copies()
    got = near_dedup.near_duplicates(frame(spark, rows), 85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 85)


def test_awkward_documents(spark):
    got = near_dedup.near_duplicates(frame(spark)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(TEXTS, 85)
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.9):
        pool = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
        both = int(share * len(pool))
        a, b = pool[:both + (len(pool) - both) // 2], np.concatenate([pool[:both], pool[both + (len(pool) - both) // 2:]])
        a, b = np.sort(shingles.mix(a)), np.sort(shingles.mix(b))
        value, spread = near_dedup.estimate(near_dedup.registers(a), len(a), near_dedup.registers(b)[None], np.array([len(b)]))
        assert abs(value[0] - share) < 4 * max(spread[0], 0.04)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(300, 200), (200, 300), (5, 5)]
    got, _ = components(spark.createDataFrame(edges, "a long, b long"), "test")
    got = {r["node"]: r["comp"] for r in got.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}, 200: 200, 300: 200}


def test_shingle_pieces_agree(monkeypatch):
    items = [f"w{k}".encode() for k in range(500)]
    whole = shingles.hashes(items)
    monkeypatch.setattr(shingles, "PIECE", 37)
    assert shingles.hashes(items).tolist() == whole.tolist()


def test_the_estimate_loses_less_than_the_bands():
    """Binomial tail of a pair exactly at the threshold, for any number of used registers."""
    for percent in (80, 85):
        p = percent / 100
        bands = (1 - p ** near_dedup.ROWS) ** near_dedup.BANDS
        for used in range(1, near_dedup.REGISTERS + 1):
            regs = np.arange(near_dedup.REGISTERS) < used
            _, spread = near_dedup.estimate(regs.astype(np.uint16), 500, regs.astype(np.uint16)[None], np.array([500]), percent)
            lost = sum(math.comb(used, k) * p ** k * (1 - p) ** (used - k) for k in range(used + 1)
                       if k / used + near_dedup.MARGIN * spread[0] < p)
            assert lost < bands, (percent, used, lost)


def test_words_that_defeat_polynomial_hashes_stay_apart(spark):
    """Alternating words of a power of two letters and their swapped twins are equal for any polynomial modulo 2 ** 64."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(4096))
    two = one.translate(str.maketrans("ab", "ba"))
    assert shingles.word_hashes([one.encode()])[0] != shingles.word_hashes([two.encode()])[0]
    rows = [(1, f"x {one} y z w v"), (2, f"x {two} y z w v"), (3, f"{one} {two}"), (4, f"{two} {one}")]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4}


def test_word_hashes_are_distinct_and_free_of_place():
    words = [w.encode() for w in sorted({f"{a}{b}" for a in "abcxyz019" for b in range(3000)})]
    each = shingles.word_hashes(words)
    assert len(np.unique(each)) == len(words)
    assert (shingles.word_hashes(words[500:700]) == each[500:700]).all()
