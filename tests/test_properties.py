"""Property tests: upserts and dedup against plain-Python brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.operators.dedup import dedup_latest
from eventmart.operators.upsert import merge_replace, upsert_latest

SCHEMA = "event_id string, occurred_at_utc timestamp, event_date date, v string, _ingested_at timestamp"
BASE = dt.datetime(2026, 1, 1)

row = st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 3), st.integers(0, 2), st.integers(0, 999))


def to_rows(spec):
    out = []
    for key, hours, ingest, v in spec:
        t = BASE + dt.timedelta(hours=hours * 13)
        out.append((key, t, t.date(), f"v{v}", BASE + dt.timedelta(days=ingest)))
    return out


def brute_latest(rows):
    best = {}
    for r in rows:
        cur = best.get(r[0])
        if cur is None or (r[1], -r[4].timestamp()) > (cur[1], -cur[4].timestamp()):
            best[r[0]] = r
    return best


SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=12, unique_by=lambda r: (r[0], r[1], r[2])))
def test_dedup_matches_brute_force(spark, spec):
    rows = to_rows(spec)
    got = {r["event_id"]: (r["occurred_at_utc"], r["_ingested_at"])
           for r in dedup_latest(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {k: (r[1], r[4]) for k, r in brute_latest(rows).items()}
    assert got == want


@SETTINGS
@given(st.lists(row, max_size=8, unique_by=lambda r: r[0]),
       st.lists(row, max_size=10, unique_by=lambda r: (r[0], r[1], r[2])))
def test_upsert_matches_brute_force(spark, target_spec, incoming_spec):
    target = to_rows(target_spec)
    incoming = to_rows(incoming_spec)
    tdf = spark.createDataFrame(target, SCHEMA).drop("_ingested_at")
    idf = spark.createDataFrame(incoming, SCHEMA)
    got = sorted(tuple(r) for r in upsert_latest(tdf, idf).collect())
    state = {r[0]: r[:4] for r in target}
    for key, r in brute_latest(incoming).items():
        if key not in state or r[1] > state[key][1]:
            state[key] = r[:4]
    assert got == sorted(state.values())
    again = sorted(tuple(r) for r in upsert_latest(upsert_latest(tdf, idf), idf).collect())
    assert again == got


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", None, "y"]), st.integers(0, 9)), max_size=6, unique_by=lambda r: r[0]),
       st.lists(st.tuples(st.sampled_from(["x", None, "z"]), st.integers(0, 9)), max_size=6, unique_by=lambda r: r[0]))
def test_merge_replace_matches_brute_force(spark, target, incoming):
    schema = "site_id string, event_date date, k string, n int"
    d = dt.date(2026, 1, 1)
    t = spark.createDataFrame([("s", d, k, n) for k, n in target], schema)
    i = spark.createDataFrame([("s", d, k, n) for k, n in incoming], schema)
    got = sorted(((r["k"] or ""), r["n"]) for r in merge_replace(t, i, ["site_id", "event_date", "k"]).collect())
    state = dict(target)
    state.update(dict(incoming))
    assert got == sorted(((k or ""), n) for k, n in state.items())
