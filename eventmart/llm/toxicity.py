"""Operator 10: toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters of other scripts to Latin ones, zero-width characters out,
and digits or signs within a word to the letters that they stand for. The lexicon is learned from labelled rows:
word beginnings (``PREFIXES`` letters) and whole words that are significantly more frequent in toxic texts, weighted
by their log odds. Copies of a text count once, and of nested terms the most telling stays. Exception phrases are pairs of
neighbouring words with a lexicon term that clean texts use; a term within one does not count. A text's weight is
divided by a slowly growing function of its length and mapped to 0..1 by a logistic curve fitted to the same rows.

The fit uses at most ``FIT_ROWS`` labelled rows of each class, chosen by a hash of doc_id; the lexicon has at most ``TERMS`` terms,
so the automaton that goes to the tasks is bounded. Every text is scored whole.

Edge cases: null and empty texts have no words and get the score of a text without terms; without labelled rows, or
with one class only, the lexicon is empty and every score is 0; repeated rows count each; equal terms are taken in
alphabetical order; other columns are ignored by `score_documents` and kept by `keep`.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from eventmart.llm import shingles
from eventmart.llm.common import drop, labelled_sample, written

FIT_ROWS = 12_000
#: A word stands among the candidates with its beginnings.
BEGINNINGS = 7
TERMS = 5_000
PREFIXES = range(3, 9)
#: Smallest shingle hashes by which copies are recognised in the sample.
SKETCHES = 4

# Look-alike letters (Cyrillic, Greek) and the Latin letters that they resemble.
LOOK_ALIKES = "аaвbеeкkмmнhоoрpсcтtуyхxіiјjѕsԁdցgαaβbεeηnιiκkνvοoρpτtυuχxγy"
# Digits and signs that stand for letters within a word.
STAND_INS = "0o1i3e4a5s7t@a$s"

_FOLD = str.maketrans(dict(zip(LOOK_ALIKES[::2], LOOK_ALIKES[1::2], strict=True)) | dict.fromkeys(
    "​‌‍⁠﻿­", ""))
_DIGITS = str.maketrans(dict(zip(STAND_INS[::2], STAND_INS[1::2], strict=True)))
_MIXED = re.compile(r"[0-9@$]*[^\W\d_]+[0-9@$]+[^\W_@$]*[\w@$]*|[0-9@$]+[^\W\d_][\w@$]*")
_HAS_STAND_IN = re.compile(r"[013457@$]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    """Folded text: words of letters only, lower case, parted and framed by single spaces."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_FOLD)
    if _HAS_STAND_IN.search(text):
        text = _MIXED.sub(lambda m: m[0].translate(_DIGITS), text)
    found = _WORD.findall(text)
    return f" {' '.join(found)} " if found else " "


@dataclass
class Lexicon:
    """Terms start at a word's beginning (leading space); one with a trailing space is a whole word."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    slope: float = 0.0
    offset: float = -20.0
    _automaton: object = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        import ahocorasick

        if self._automaton is None:
            automaton = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                automaton.add_word(term, (term, weight))
            for phrase in self.exceptions:
                automaton.add_word(phrase, (phrase, None))
            automaton.make_automaton()
            self._automaton = automaton
        return self._automaton

    def weigh(self, text: str | None) -> tuple[float, int, int]:
        """Weight of the terms in a text (one per word, the heaviest), words with a term, and words."""
        folded = fold(text)
        words = max(0, folded.count(" ") - 1)
        if not self.terms:
            return 0.0, 0, words
        excused: list[tuple[int, int]] = []
        heaviest: dict[int, float] = {}
        for end, (term, weight) in self.automaton().iter(folded):
            start = end - len(term) + 1
            if weight is None:
                excused.append((start, end))
            else:
                heaviest[start] = max(weight, heaviest.get(start, 0.0))
        for start, end in excused:
            for at in [a for a in heaviest if start <= a < end]:
                del heaviest[at]
        return sum(heaviest.values()), len(heaviest), words

    def judge(self, text: str | None) -> tuple[float, float, int, int]:
        """Score, log density, words with a term, and words.

        The weight is divided by a function of length that grows from 1 for no word to 10 for a million.
        """
        weight, hits, words = self.weigh(text)
        density = math.log1p(weight / (1 + 1.5 * math.log10(1 + words)))
        x = self.slope * density + self.offset
        return (1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) if self.terms else 0.0), density, hits, words


def _word_terms(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:k]}" for k in PREFIXES if k <= len(word))
    return found


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by regularised Newton steps."""
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + 1e-2 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(beta[0]), float(beta[1])


def _significance(n_toxic: int, n_clean: int) -> Column:
    """Log-likelihood ratio (G2) of a term's counts ``toxic`` and ``clean`` against equal rates."""
    toxic, clean, n = F.col("toxic").cast("double"), F.col("clean").cast("double"), float(n_toxic + n_clean)
    total = toxic + clean

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    return 2 * (part(toxic, total * (n_toxic / n)) + part(clean, total * (n_clean / n))
                + part(n_toxic - toxic, (n - total) * (n_toxic / n)) + part(n_clean - clean, (n - total) * (n_clean / n)))


def _chosen(found: dict[str, tuple[float, int, int]], n_toxic: int, n_clean: int, most: int) -> dict[str, float]:
    """Weights of the most telling terms, none beginning another; of terms in nearly the same texts the longest."""
    chosen: dict[str, float] = {}
    taken: set[str] = set()  # chosen terms and their beginnings
    names = sorted(found)
    for term in sorted(found, key=lambda t: (-found[t][0], t)):
        if term in taken or any(term[:k] in chosen for k in range(2, len(term) + 1)):
            continue
        at = bisect.bisect_left(names, term)
        longer = [t for t in itertools.takewhile(lambda t: t.startswith(term), names[at:])
                  if found[t][1] >= 0.9 * found[term][1] and not t.endswith(" ")]
        term = max([term, *longer], key=lambda t: (len(t), t))
        _, toxic, clean = found[term]
        chosen[term] = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        taken.update(term[:k] for k in range(2, len(term) + 1))
        if len(chosen) == most:
            break
    return chosen


def _without_copies(rows: list[tuple]) -> list[int]:
    """Places of rows (label, sketches) that share no sketch with an earlier kept row of their label."""
    seen: set[tuple] = set()
    kept = []
    for k, (label, sketches) in enumerate(rows):
        marks = {(label, i, s) for i, s in enumerate(sketches)}
        if not marks & seen:
            kept.append(k)
            seen |= marks
    return kept


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, terms: int = TERMS) -> Lexicon:
    """Lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), at most ``rows`` labelled rows of each class."""
    labels = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
              .groupBy("doc_id").agg(F.min("toxic").alias("toxic")))
    totals = {r["toxic"]: r["count"] for r in labels.join(docs.select("doc_id"), "doc_id", "left_semi")
              .groupBy("toxic").count().collect()}
    sample = labelled_sample(docs, labels.where("toxic = 0"), rows).unionByName(
        labelled_sample(docs, labels.where("toxic = 1"), rows))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                hashes = shingles.shingle_set(text, 3)
                found.append([int(shingles.mix(hashes + np.uint64(k)).min().view(np.int64)) if len(hashes) else 0
                              for k in range(SKETCHES)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))],
                                             names=["doc_id", "text", "toxic", "sketches"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                folded = fold(text)
                counts.update((t, bool(toxic)) for t in _word_terms(folded))
                counts[("", bool(toxic))] += 1
        cells = sorted(counts.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for (t, _), _ in cells], pa.string()), pa.array([n * x for (_, x), n in cells], pa.int64()),
             pa.array([n * (not x) for (_, x), n in cells], pa.int64())], names=["term", "toxic", "clean"])

    # The sample is dealt anew so that counting runs in parallel.
    whole_sample, path = written(
        sample.repartition(F.xxhash64("doc_id", "text")).select(
            F.col("doc_id").cast("long"), "text", F.col("toxic").cast("int"))
        .mapInArrow(sketch, "doc_id long, text string, toxic int, sketches array<long>"), "toxicity-sample")
    # Copies of a text would make all its words telling; one of each group counts.
    marks = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["toxic"], r["sketches"])
                   for r in whole_sample.select("doc_id", "toxic", "sketches").collect())
    kept = [marks[k][1] for k in _without_copies([(m[2], m[3]) for m in marks])]
    sample, sample_path = written(whole_sample.where(F.col("doc_id").isin(kept)).select("doc_id", "text", "toxic")
                                  .repartition(F.xxhash64("doc_id", "text")), "toxicity-texts")
    counted = sample.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted, counted_path = written(counted, "toxicity-terms")
    whole = counted.where("term = ''").first()
    if not whole or not whole["toxic"] or not whole["clean"]:
        return Lexicon()
    n_toxic, n_clean = whole["toxic"], whole["clean"]
    # As many comparisons as candidates are allowed for one false term in twenty fits.
    least = 2 * math.log(20 * max(counted.count(), 1))
    # The most significant ones of those that pass; several beginnings of a word stand beside it, hence the factor.
    telling = (counted.where(f"term <> '' and toxic >= 4 and toxic * {n_clean} > 4 * clean * {n_toxic}")
               .withColumn("g2", _significance(n_toxic, n_clean)).where(F.col("g2") >= least)
               .orderBy(F.desc("g2"), "term").limit(BEGINNINGS * terms).collect())
    found = {r["term"]: (r["g2"], r["toxic"], r["clean"]) for r in telling}
    lexicon = Lexicon(_chosen(found, n_toxic, n_clean, terms))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hit(folded: str) -> bool:
            return bool(lexicon.terms) and any(True for _ in lexicon.automaton().iter(folded))

        for batch in batches:
            phrases: Counter = Counter()
            for text, toxic in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = fold(text).split()
                pairs = {f" {a} {b} " for a, b in zip(words, words[1:], strict=False)} if hit(f" {' '.join(words)} ") else ()
                phrases.update((p, bool(toxic)) for p in pairs if hit(p))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in phrases], pa.string()), pa.array([n * x for (_, x), n in phrases.items()], pa.int64()),
                 pa.array([n * (not x) for (_, x), n in phrases.items()], pa.int64())], names=["term", "toxic", "clean"])

    excused = (sample.mapInArrow(judge, "term string, toxic long, clean long").groupBy("term")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where(f"clean >= 3 and toxic * {n_clean} < clean * {n_toxic}")
               .orderBy(F.desc("clean"), "term").limit(terms).collect())
    lexicon.exceptions = {r["term"] for r in excused}

    def densities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lexicon.judge(t)[1] for t in batch.column(1).to_pylist()], pa.float64()),
                 batch.column(2).cast(pa.int32())], names=["x", "y"])

    points = sample.mapInArrow(densities, "x double, y int").collect()  # at most 2 * ``rows`` pairs of numbers
    order = sorted((p["x"], p["y"]) for p in points)
    lexicon.slope, lexicon.offset = _logistic(np.array([x for x, _ in order]), np.array([y for _, y in order], float))
    # The classes may be sampled at different rates.
    lexicon.offset += math.log(max(1, totals.get(1, 0) / rows)) - math.log(max(1, totals.get(0, 0) / rows))
    drop(sample.sparkSession, path, sample_path, counted_path)
    return lexicon


def score_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, n_terms and n_words of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.judge(text) for text in batch.column(1).to_pylist()]
            score, _, terms, words = list(zip(*found, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(score, pa.float64()), pa.array(terms, pa.int64()),
                 pa.array(words, pa.int64())],
                names=["doc_id", "score", "n_terms", "n_words"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_terms long, n_words long")


def keep(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf(BooleanType())
    def toxic(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.judge(t)[0] >= threshold for t in texts], dtype=bool)

    return docs.where(~toxic("text"))
