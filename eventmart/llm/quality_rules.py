"""Operator 5: quality rules as a short-circuit cascade, with DataFrame functions only.

Each rule is a predicate over a text. On a sample (``SAMPLE`` rows, written once) every rule is run alone; its time
is its cost and the share of rows it rejects its selectivity. The rules then run in the order of rejection per
cost, as one CASE expression that stops at the first rejection. The order never changes a verdict.

Base figures of a text: words are runs outside space and 0x09-0x0D; a duplicate line is a line with a word that
equals an earlier one; a repeated word lies in an 8-word window found twice or more in the text. Windows are
compared by 64-bit hashes sorted within the text, so a text of any length costs n log n.

Edge cases: a null or empty text has no words and fails (too few words); an empty table gives no rows and the rules
keep their declared order; repeated rows get equal verdicts; other columns are ignored by `figures` and kept by
`keep`.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import drop, written

SAMPLE = 1000
WINDOW = 8

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_BLANKS = r"[ \t-\r]+"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``; an alias would be copied into every place that uses it."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _BLANKS), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, _SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long")


def n_words(text: Column) -> Column:
    return F.size(_words(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.translate(s, _SPACE, "")) > 0)
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words that lie in an ``n``-word window found at two or more places, from an array of words."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, n)))

    def covered(starts: Column) -> Column:
        return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                           lambda a, i: F.struct((i + n).alias("end"),
                                                 (a["n"] + (i + n) - F.greatest(a["end"], i)).alias("n")),
                           lambda a: a["n"])

    def twice(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(pairs, lambda p: covered(F.sort_array(F.transform(
            F.filter(p, lambda x, i: (F.get(p, i - 1)["h"].eqNullSafe(x["h"]))
                     | (F.get(p, i + 1)["h"].eqNullSafe(x["h"]))),
            lambda x: x["i"]))))

    counted = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(twice(h)))
    return F.when(F.size(words) < n, F.lit(0)).otherwise(counted).cast("long")


def figures(docs: DataFrame) -> DataFrame:
    """doc_id, text and the five base figures of ``docs`` (doc_id, text); a null text counts as an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    both = _let(_words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                 repeated_words(w).alias("n_repeat_words")))
    return docs.select("doc_id", text.alias("text")).select(
        "*", both.alias("_w"), word_chars(F.col("text")).alias("word_chars"), n_symbols(F.col("text")).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines")).select(
        "doc_id", "text", F.col("_w.n_words").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("_w.n_repeat_words").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules(text: Column, words: Column, chars: Column, symbols: Column, dup_lines: Column,
          repeated: Column) -> dict[str, Column]:
    """Name and rejecting predicate of each rule, over a text that is not null and its base figures."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    return {
        "too_few_words": words < 20,
        "repeated_windows": 100 * repeated > 30 * words,
        "symbols": 10 * symbols > words,
        "word_length": (chars < 2 * words) | (chars > 15 * words),
        "duplicate_lines": 10 * dup_lines > 3 * F.size(F.split(text, "\n")),
        "letters": 10 * letters < 6 * chars,
        "capitals": 10 * upper > 3 * letters,
    }


def rules_on_text(text: Column) -> dict[str, Column]:
    """The same rules, each computing the figures that it needs; a cascade pays only for rules that it reaches."""
    repeated = _let(_words(text), lambda w: repeated_words(w))
    return rules(text, n_words(text), word_chars(text), n_symbols(text), n_dup_lines(text), repeated)


def cascade(rejects: dict[str, Column], order: list[str]) -> Column:
    """Name of the first rule in ``order`` that rejects, null if none does; later rules are not evaluated."""
    first, *rest = order
    chain = F.when(rejects[first], F.lit(first))
    for name in rest:
        chain = chain.when(rejects[name], F.lit(name))
    return chain


def ordered_rules(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """Rule names by rejection per cost, measured on ``sample`` rows of ``docs``."""
    rows, path = written(docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).limit(sample), "rule-sample")
    measured = {}
    for name, rejects in rules_on_text(F.col("text")).items():
        began = time.perf_counter()
        got = rows.agg(F.avg(rejects.cast("int")).alias("share")).first()
        measured[name] = (got["share"] or 0.0) / max(time.perf_counter() - began, 1e-6)
    drop(docs.sparkSession, path)
    return sorted(measured, key=lambda name: -measured[name])


def keep(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with all their columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.where(cascade(rules_on_text(text), ordered_rules(docs, sample)).isNull())


def report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the base figures, base_failed and kept; the cascade reads the figures, which are wanted anyway."""
    order = ordered_rules(docs, sample)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rejects = rules(F.col("text"), *map(F.col, names))
    return figures(docs).select(
        "doc_id", *names, base_failed().alias("base_failed"),
        (~base_failed() & cascade(rejects, order).isNull()).alias("kept"))
