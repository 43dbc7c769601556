r"""Operator 13: fill-in-the-middle examples by one counted-quantifier match for each row.

A text is a run of units (white space with the word after it, or the white space at the end). ``regexp_count`` gives
their number n, a hash of doc_id two cut places a <= b, and the row's own pattern

    \A((?:unit){a}+)((?:unit){b-a}+)(.*)\z

captures prefix, middle and suffix in one match, whose replacement text already is the output. The quantifiers are
possessive, so the match goes once over the text without stacking or backtracking, however long the text is.

Edge cases: a null text is an empty one, stays plain and has 0 units; a text that holds a sentinel stays plain, so that
every other output can be taken apart again (`restore`); a null doc_id is hashed as no digits; repeated rows give equal
rows; an empty table gives no rows. `infill` keeps the other columns, but for those that have the names of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space and the word after it, or the white space at the end. Possessive: the two classes share no character.
UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
#: Marks before prefix, suffix and middle (fixed values).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: What `infill` adds.
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def _draws(seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def infill(docs: DataFrame, seed: int = 42, plain_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text and others) with n, form, prefix_chars, middle_chars and output.

    Of 100 texts ``plain_percent`` stay plain; of the others ``spm_percent`` of 100 take the order suffix, prefix, middle.
    """
    cut1, cut2, rate, order = _draws(seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    sentinel = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    rows = (docs.drop(*ADDED).withColumn("n", F.regexp_count(text, F.lit(UNIT)).cast("long"))
            .withColumn("form", F.when((text == "") | sentinel | (rate % 100 >= 100 - plain_percent), "plain")
                        .when(order % 100 < spm_percent, "spm").otherwise("psm")))
    one, two = cut1 % (F.col("n") + 1), cut2 % (F.col("n") + 1)
    a, b = F.least(one, two), F.greatest(one, two)
    pattern = F.format_string(rf"(?s)\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*)\z", a, b - a)
    filled = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(
        f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    rows = rows.withColumn("output", F.when(F.col("form") == "plain", text)
                           .otherwise(F.regexp_replace(text, pattern, filled)))
    start = F.when(F.col("form") == "spm", F.instr("output", PREFIX)).otherwise(F.lit(1)) + len(PREFIX)
    end = F.when(F.col("form") == "spm", F.instr("output", MIDDLE)).otherwise(F.instr("output", SUFFIX))
    changed = F.col("form") != "plain"
    return (rows.withColumn("prefix_chars", F.when(changed, (end - start).cast("long")))
            .withColumn("middle_chars", F.when(changed, (F.length("output") - F.instr("output", MIDDLE)
                                                         - len(MIDDLE) + 1).cast("long")))
            .select(*[c for c in docs.columns if c not in ADDED], *ADDED))


def restore(form: Column, output: Column) -> Column:
    """The exact text from an output and its form; sentinels are there once each, as no changed text holds one."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z", "$2$3$1")
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
