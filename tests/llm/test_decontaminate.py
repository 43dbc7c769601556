import numpy as np

from eventmart.llm import decontaminate, shingles
from tests.llm.cases import babble, empty, frame

ITEMS = "item_id long, text string, score string"


def items(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], ITEMS)


def test_index_finds_all_within_radius():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    index = decontaminate.HammingIndex(prints, 18)
    for k in range(200):
        one = prints[k] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 25)), replace=False)))
        distance = np.bitwise_count(prints ^ one)
        at, found = index.near(one)
        assert at.tolist() == np.flatnonzero(distance <= 18).tolist() and found.tolist() == distance[at].tolist()


def corpus():
    rng = np.random.default_rng(4)
    bench = [(k, " ".join(babble(rng, int(rng.integers(8, 50)), 3000))) for k in range(30)]
    docs = []
    for k in range(150):
        text = babble(rng, int(rng.integers(3, 200)), 3000)
        if k % 3 == 0:
            passage = bench[int(rng.integers(30))][1].split()
            for _ in range(int(rng.integers(0, 4))):
                passage[int(rng.integers(len(passage)))] = "changed"
            at = int(rng.integers(0, len(text) + 1))
            text[at:at] = passage
        docs.append((k, " ".join(text).capitalize() + "."))
    return docs, bench


def brute(docs, bench):
    """Best weighted similarity over all item-sized windows, without fingerprints."""
    sets = {i: np.unique(shingles.hashes(decontaminate.tokens(t))) for i, t in bench}
    counts: dict[int, int] = {}
    for s in sets.values():
        for g in s.tolist():
            counts[g] = counts.get(g, 0) + 1
    weight = lambda g: 1 + np.log((len(sets) + 1) / (counts.get(g, 0) + 1))
    found = {}
    for d, text in docs:
        grams = shingles.hashes(decontaminate.tokens(text)).tolist()
        for i, own in sets.items():
            own = set(own.tolist())
            width = min(len(decontaminate.tokens(dict(bench)[i])) - 4, len(grams))
            best = max((sum(map(weight, own & w)) / sum(map(weight, own | w))
                        for w in (set(grams[s:s + width]) for s in range(len(grams) - width + 1))), default=0)
            if best >= 0.8:
                found[d, i] = round(best, 6)
    return found


def test_matches_equal_brute_force(spark):
    docs, bench = corpus()
    got = {(r["doc_id"], r["item_id"]): r["similarity"]
           for r in decontaminate.matches(frame(spark, docs), items(spark, bench)).collect()}
    want = brute(docs, bench)
    assert len(want) > 10 and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)


def test_chunks_of_items_add_up(spark):
    docs, bench = corpus()
    got = decontaminate.matches(frame(spark, docs), items(spark, bench), chunk=7)
    one = decontaminate.matches(frame(spark, docs), items(spark, bench))
    exact = lambda df: {(r["doc_id"], r["item_id"]) for r in df.collect() if r["similarity"] == 1.0}
    assert exact(got) == exact(one)


def test_awkward_rows(spark):
    bench = [(1, None), (2, ""), (3, "one"), (4, "The cat sat on the mat, again!"), (4, "the cat sat on the mat again"),
             (None, "émoji 😀 and ünïcode text")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(frame(spark), items(spark, bench)).collect()}
    assert got == {(3, 3), (5, 4), (6, 4), (9, None)}
    kept = decontaminate.clean(frame(spark), items(spark, bench))
    assert kept.columns == frame(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "4", "None", "None", "7", "8", "10"])
    assert decontaminate.matches(empty(spark), items(spark, bench)).count() == 0
    assert decontaminate.matches(frame(spark), items(spark, bench).limit(0)).count() == 0


def test_every_match_is_the_same_in_chunks(spark):
    rng = np.random.default_rng(14)
    docs, bench = corpus()
    # Items that share passages, and windows near the threshold.
    bench += [(100 + k, " ".join(bench[k][1].split()[:-2] + babble(rng, 3, 3000))) for k in range(15)]
    whole = decontaminate.matches(frame(spark, docs), items(spark, bench)).collect()
    parts = decontaminate.matches(frame(spark, docs), items(spark, bench), chunk=4).collect()
    assert len(whole) > 12 and sorted(map(tuple, whole)) == sorted(map(tuple, parts))
