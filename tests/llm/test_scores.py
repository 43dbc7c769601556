import numpy as np
import pytest

from eventmart.llm import quality_knn, queries, quality_rules, toxicity
from eventmart.llm.common import labelled_sample, table
from tests.llm.cases import TEXTS, empty, frame, words

SF = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in queries.toxicity_query(spark, SF).collect()}
    labels = [(r["doc_id"], r["toxic"]) for r in table(spark, SF, "labels").collect()]
    held = [(got[d]["predicted"], y) for d, y in labels if d in got and got[d]["held_out"]]
    assert np.mean([p == y for p, y in held]) >= 0.9
    assert np.mean([p for p, y in held if y == 0]) <= 0.03


def test_quality_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in queries.quality_classifier(spark, SF).collect()}
    labels = [(r["doc_id"], r["quality"]) for r in table(spark, SF, "labels").collect()]
    held = [(got[d]["score"], y) for d, y in labels if d in got and got[d]["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def labels_of(spark, column, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], f"doc_id long, {column} int, text string")


def test_toxicity_awkward_rows(spark):
    for rows in ([], [(5, 1), (6, 1)], [(5, 1), (7, 0), (1, 0), (None, 1), (3, None), (99, 1)]):
        lexicon = toxicity.fit(frame(spark), labels_of(spark, "toxic", rows))
        got = toxicity.score_documents(frame(spark), lexicon).collect()
        assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
        assert toxicity.keep(frame(spark), lexicon).columns == frame(spark).columns
        assert toxicity.score_documents(empty(spark), lexicon).count() == 0
    assert toxicity.fit(empty(spark), labels_of(spark, "toxic", [(1, 1), (2, 0)])).terms == {}


def test_lexicon_folds_and_excuses():
    lexicon = toxicity.Lexicon({" scum": 3.0, " idiot ": 2.0}, {" scum bucket "}, 5.0, -3.0)
    assert lexicon.weigh("You SCUM!")[:2] == (3.0, 1)
    assert lexicon.weigh("ѕсum and 5cum, 1d1ot")[:2] == (8.0, 3)  # Cyrillic letters, digits
    assert lexicon.weigh("a scum bucket")[:2] == (0.0, 0)
    assert lexicon.weigh("idiotic 2015 12")[:2] == (0.0, 0)
    assert lexicon.judge("scum " + "fine " * 2000)[0] < lexicon.judge("scum fine")[0]
    assert lexicon.weigh(None) == (0.0, 0, 0)


def test_quality_awkward_rows(spark):
    for rows in ([], [(5, 1)], [(5, 1), (7, 0), (1, 0), (2, 1), (None, 1), (3, None)]):
        space = quality_knn.fit(frame(spark), labels_of(spark, "quality", rows))
        got = quality_knn.score_documents(frame(spark), space).collect()
        assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
        assert quality_knn.score_documents(empty(spark), space).count() == 0


def test_neighbours_equal_brute_force():
    rng = np.random.default_rng(0)
    texts = [" ".join("abcdefgh"[k % 8] * (1 + k % 5) for k in rng.integers(0, 99, 60)) for _ in range(90)]
    vectors = np.stack([quality_knn.counts(t) for t in texts[:60]])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    space = quality_knn.Space(np.eye(quality_knn.DIM, dtype=np.float32), vectors, np.ones(60), np.arange(60) % 2.0, 0.5)
    for text, got in zip(texts[60:], space.scores(texts[60:], block=7), strict=True):
        v = quality_knn.counts(text)
        cosines = vectors @ v / np.linalg.norm(v)
        near = np.argsort(-cosines)[:quality_knn.NEIGHBOURS]
        weight = cosines[near] ** quality_knn.SHARPNESS
        assert got == pytest.approx((weight * (near % 2)).sum() / weight.sum(), abs=1e-3)


def figures(text):
    w, seen, dup = words(text), set(), 0
    at: dict = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    repeated = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(8)}
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated),
            len(w) < 20 or 100 * len(repeated) > 30 * len(w))


def test_rules_awkward_rows(spark):
    rows = [*TEXTS, (20, "a b c d e f g h " * 30), (21, "same line here\n" * 40), (22, "x| y| " * 40),
            (23, "good words in a row " + " ".join(f"plain{c}" for c in "abcdefghijklmnopqrstuvwxyz"))]
    got = quality_rules.report(frame(spark, rows)).collect()
    key = lambda r: str(tuple(r)[:7])
    assert sorted(map(key, got)) == sorted(str((d, *figures(t))) for d, t in rows)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert 23 in kept and not kept & {1, 2, 3, 20, 21, 22}
    assert {r["doc_id"] for r in quality_rules.keep(frame(spark, rows)).collect()} == kept
    assert quality_rules.report(empty(spark)).count() == 0
    assert set(quality_rules.ordered_rules(empty(spark))) == set(quality_rules.ordered_rules(frame(spark)))


def test_a_repeated_labelled_id_is_one_row(spark):
    rows = [(1, f"text {k}") for k in range(300)] + [(k, "other") for k in range(2, 40)]
    labels = labels_of(spark, "toxic", [(1, 1)] * 5 + [(1, 0), *((k, k % 2) for k in range(2, 40))])
    sample = labelled_sample(frame(spark, rows), labels.select("doc_id", "toxic"), 20).collect()
    assert len(sample) == 20 and len({r["doc_id"] for r in sample}) == 20
    whole = labelled_sample(frame(spark, rows), labels.select("doc_id", "toxic"), 100).collect()
    assert [(r["toxic"], r["text"].startswith("text")) for r in whole if r["doc_id"] == 1] == [(0, True)]


def rare(n=3000, toxic=12):
    """Labelled rows of which few are toxic; each of those holds two planted words."""
    rng = np.random.default_rng(12)
    names = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), 6)) for _ in range(500)]
    texts = [" ".join(rng.choice(names, 30)) for _ in range(n)]
    return [(k, t + " grobian and flegelhaft" if k < toxic else t) for k, t in enumerate(texts)], [(k, int(k < toxic)) for k in range(n)]


def test_a_rare_class_keeps_its_rows(spark):
    rows, labels = rare()
    lexicon = toxicity.fit(frame(spark, rows), labels_of(spark, "toxic", labels), rows=200)
    assert any("grobian" in t for t in lexicon.terms) and any("flegel" in t for t in lexicon.terms)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(frame(spark, rows), lexicon).collect()}
    assert min(scores[k] for k in range(12)) > 0.3 and max(scores[k] for k in range(12, 3000)) < 0.3


def test_toxicity_scores_equal_a_plain_scan():
    """The automaton, the exceptions and the score against a scan of every place of the folded text."""
    rng = np.random.default_rng(3)
    terms = {" scum": 2.5, " idiot ": 2.0, " lout": 1.5, " oaf ": 1.0}
    lexicon = toxicity.Lexicon(terms, {" scum bucket ", " my lout "}, 40.0, -2.0)
    pool = ["scum", "scumbag", "idiot", "idiotic", "lout", "louts", "oaf", "my", "bucket", "fine", "day", "ok", "1d1ot", "sсum"]
    for _ in range(300):
        text = " ".join(rng.choice(pool, int(rng.integers(0, 25))))
        folded = toxicity.fold(text)
        body = f" {' '.join(folded.split())} "
        covered = set()
        for phrase in lexicon.exceptions:
            at = body.find(phrase)
            while at >= 0:
                covered |= set(range(at, at + len(phrase)))
                at = body.find(phrase, at + 1)
        found = [w for t, w in terms.items() for at in range(len(body)) if body.startswith(t, at)
                 and not set(range(at, at + len(t))) <= covered]
        weight, n_terms, n_words = lexicon.weigh(text)
        assert (round(weight, 6), n_terms, n_words) == (round(sum(found), 6), len(found), len(body.split()))
