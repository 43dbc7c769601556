import numpy as np
from pyspark.sql import functions as F

from eventmart.llm import line_dedup
from tests.llm.cases import TEXTS, babble, empty, frame

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, min_chars=20, min_docs=3):
    low = lambda d: (d is not None, d or 0)
    held = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(low(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and low(doc_id) < max(held[key(x)]))]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(map(str, out))


def cases():
    rng = np.random.default_rng(5)
    common = [" ".join(babble(rng, 6)) + " a line of some length" for _ in range(40)]
    rows = [*TEXTS, (None, "the very same line is here\nown"), (None, "the very same line is here"),
            (-5, "the very same line is here\n"), (900, "THE very same line is here  \t"), (901, "ÀÉ the very same line Is here"),
            (902, "àé the very same line is here"), (903, "ÀÉ the very same line is here"), (904, "ÀÉ THE very same line is here")]
    for i in range(400):
        lines = [common[int(k)] for k in rng.integers(0, 40, int(rng.integers(0, 6)))]
        lines += [" ".join(babble(rng, 8)) for _ in range(int(rng.integers(0, 4)))] + ["short", ""]
        rng.shuffle(lines)
        rows.append((int(rng.integers(0, 300)), "\n".join(lines).upper() if i % 7 == 0 else "\n".join(lines)))
    rows += [(10_000 + i, "this line stands in a third of all rows\nbut not " + " ".join(babble(rng, 9))) for i in range(200)]
    rows += [(77, "a row that comes again and again\nwith two lines of text")] * 150
    return rows


def test_kept_texts_equal_the_plain_way(spark):
    rows = cases()
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)
    got = line_dedup.dedup_lines(frame(spark, rows), min_chars=5, min_docs=2, batches=3).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, 5, 2)


def test_many_lines_and_no_rows(spark):
    rows = [(i, "\n".join(f"line number {k} of a long text" for k in range(i, 60_000))) for i in range(4)]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert [got[i]["n_dropped"] for i in range(4)] == [59_998, 59_998, 59_997, 0]
    assert got[0]["text"] == "line number 0 of a long text\nline number 1 of a long text"
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_runs_stay_few_and_the_merge_joins_need_no_exchange_of_them(spark):
    runs = line_dedup.LineRuns(spark)
    for k in range(9):
        batch = spark.range(50 * k, 50 * k + 100).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("h"),
                                                         F.lit(k).cast("long").alias("doc_id"))
        runs.add(batch)
    assert [len(level) for level in runs.levels] in ([1, 0, 0, 1], [1, 2, 1], [1, 0, 2])
    with line_dedup._sorted_buckets(spark):
        names = runs.runs()
        plan = (runs._run(names[0]).join(runs._run(names[-1]).hint("merge"), "h", "left_anti"))
        text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text and "Sort [" not in text
    shared = {bytes(r["h"]): r["last"] for r in runs.shared(2).collect()}
    assert len(shared) == 400 and runs.shared(3).count() == 0
    runs.drop()
