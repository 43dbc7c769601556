import hashlib
import re

from pyspark.sql import functions as F

from eventmart.llm import infill
from tests.llm.cases import TEXTS, empty, frame

LONG_UNITS = " ".join(f"unit{i}" for i in range(300_000))


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, text, n, "plain", None, None, text
    out, form = (f"<S>{s}<P>{p}<M>{m}", "spm") if h4 % 100 < 80 else (f"<P>{p}<S>{s}<M>{m}", "psm")
    return doc_id, text, n, form, len(p), len(m), out


ROWS = [*TEXTS, *[(100 + i, t) for i in range(40) for t in (
    "a b  c\nd\te f ", " lead and trail \r\n", "x", "$1 \\2 cost $", "<", "< P> <<P", "a<S>b c", "   ",
    "words\x0b\x0cand more kinds \U0001d11e\U0001d11e of space")],
    *[(5000 + i, LONG_UNITS) for i in range(4)]]


def test_every_row_equals_the_plain_way_and_comes_back(spark):
    made = infill.infill(frame(spark, ROWS))
    got = made.select("doc_id", F.coalesce("text", F.lit("")), *infill.ADDED,
                      infill.restore(F.col("form"), F.col("output")).alias("back")).collect()
    assert sorted(map(str, (tuple(r)[:-1] for r in got))) == sorted(str(brute(*r)) for r in ROWS)
    assert all(r["back"] == r[1] for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_other_columns_stay_and_no_rows_give_none(spark):
    made = infill.infill(frame(spark))
    assert made.columns.count("n") == 1 and "score" in made.columns
    assert infill.infill(empty(spark)).count() == 0
    assert infill.infill(frame(spark), plain_percent=100).where("form <> 'plain'").count() == 0
