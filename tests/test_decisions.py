"""Decisions from a time on are those of the whole past; marks go on from batch to batch."""

import random
from datetime import datetime, timedelta

import pytest

from busmill.operators import checks

T0 = datetime(2024, 1, 1)
SCHEMA = "pipeline string, status string, items_failed long, acceptance_rate double, received_at timestamp, seq long"
LIMITS = "pipeline string, max_failed_items long, max_failed_ratio double, max_consecutive_warn long, notify_on_fail boolean, notify_on_warn boolean"


def summaries(rng, n):
    """Long runs of WARN, many at one time, parts of a second, unknown states and pipelines."""
    at = T0
    for k in range(n):
        at += timedelta(milliseconds=rng.choice([0, 0, 200, 700, 3_600_000, 9_000_000]))
        yield rng.choice(["a", "b", "c", "unknown", None]), rng.choice(["WARN"] * 9 + ["PASS", "FAIL", "odd", None]), rng.choice([0, 1, 5, None]), rng.choice([1.0, 0.9, None]), at, k


@pytest.fixture(scope="module")
def limits(spark):
    return spark.createDataFrame([("a", 10_000, 5.0, 4, True, True), ("b", 30, 5.0, 10_000, True, True), ("c", 10_000, 0.5, 12, False, True)], LIMITS)


@pytest.mark.parametrize("seed", range(4))
def test_any_start_gives_the_decisions_of_the_whole(spark, limits, seed):
    rng = random.Random(seed)
    rows = list(summaries(rng, 220))
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    whole = {r.seq: r.decision for r in checks.decisions(table, limits, 6).collect()}
    assert len(whole) == len(rows) and "sent:cumulative_warn" in whole.values()
    since = rows[rng.randrange(60, 200)][4]
    before = checks.marks(spark.createDataFrame([r for r in rows if r[4] < since], SCHEMA))
    # What is older than the hours isn't there at all.
    recent = spark.createDataFrame([r for r in rows if r[4] >= since - timedelta(hours=6, seconds=1)], SCHEMA)
    found = {r.seq: r.decision for r in checks.decisions(recent, limits, 6, str(since), before).collect()}
    assert found == {r[5]: whole[r[5]] for r in rows if r[4] >= since}


def by_hand(rows, limits, hours):
    """The rule read row by row."""
    epoch, out, kept = datetime(1970, 1, 1), {}, {}
    for pipeline, status, items, rate, at, seq in sorted(rows, key=lambda r: (r[4] is not None, r[4] or T0, r[5])):
        run = kept[pipeline] = 0 if status not in ("WARN", None) else kept.get(pipeline, 0) + 1
        second = lambda t: None if t is None else (t - epoch) // timedelta(seconds=1)
        near = [r for r in rows if r[0] == pipeline and (r[4] is None if at is None else r[4] is not None and 0 <= second(at) - second(r[4]) <= hours * 3600)]
        limit = limits.get(pipeline)
        fires = limit and (sum(r[2] or 0 for r in near) >= limit[0] or sum(1 - (r[3] or 0.0) for r in near) / len(near) >= limit[1] or min(run, len(near)) >= limit[2])
        out[seq] = (
            "ignored:unknown_status" if status not in checks.RANK else "stored:pass_status" if status == "PASS" else "ignored:unknown_pipeline" if not limit else "sent:fail" if status == "FAIL" and limit[3]
            else "sent:cumulative_warn" if status == "WARN" and limit[4] and fires else "stored"
        )
    return out


@pytest.mark.parametrize("hours", [0, 1, 24, 50])
def test_decisions_by_hand(spark, hours):
    """Runs and windows over the bounds of parts, days of one time, rows without a time, any number of hours."""
    rng = random.Random(hours)
    rows = [r if k % 60 else (*r[:4], None, r[5]) for k, r in enumerate(summaries(rng, 350))]
    day = T0 + timedelta(days=30)
    rows += [("a", rng.choice(["WARN"] * 6 + ["PASS"]), 1, 1.0, day + timedelta(days=k // 9), 1000 + (k * 7) % 100) for k in range(100)]
    limits = {"a": (10_000, 5.0, 12, True, True), "b": (30, 5.0, 10_000, True, True), "c": (10_000, 0.55, 12, False, True)}
    table, settings = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame([(k, *v) for k, v in limits.items()], LIMITS)
    found = {r.seq: r.decision for r in checks.decisions(table, settings, hours).collect()}
    assert found == by_hand(rows, limits, hours) and len(found) == len(rows)


def test_no_task_holds_a_pipeline(spark, limits, tmp_path):
    """Summaries are never shuffled by pipeline alone."""
    spark.createDataFrame(list(summaries(random.Random(3), 50)), SCHEMA).write.parquet(f"{tmp_path}/s")
    table = spark.read.parquet(f"{tmp_path}/s")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in (checks.decisions(table, limits, 6), checks.decisions(table, limits, 6, str(T0 + timedelta(hours=9)), checks.marks(table)))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans:
        by_pipeline = [i for i, x in enumerate(plan.splitlines()) if "Exchange hashpartitioning(pipeline#" in x]
        # What is shuffled by pipeline are sums: the last time that isn't WARN and the count of marks.
        assert all("HashAggregate" in plan.splitlines()[i + 1] or "SortAggregate" in plan.splitlines()[i + 1] for i in by_pipeline)


def test_marks_go_on(spark):
    rows = list(summaries(random.Random(9), 200))
    run = {}
    for r in rows:
        run[r[0]] = 0 if r[1] not in ("WARN", None) else run.get(r[0], 0) + 1
    kept = None
    for a, b in ((0, 3), (3, 90), (90, 90), (90, 200)):
        kept = checks.marks(spark.createDataFrame(rows[a:b], SCHEMA), kept)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
    assert {r.pipeline: r.run for r in kept.collect()} == run
    assert {r.pipeline: r.run for r in checks.marks(spark.createDataFrame(rows, SCHEMA)).collect()} == run


def test_without_marks_no_run_goes_back(spark, limits):
    rows = [("a", "WARN", 0, 1.0, T0 + timedelta(hours=h), h) for h in range(6)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = checks.decisions(table, limits, 24, str(T0 + timedelta(hours=4)))
    assert {r.seq: r.decision for r in found.collect()} == {4: "stored", 5: "stored"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.index("Join ")  # what the windows and the join read is bounded before them
    assert any("received_at" in f.split("\n")[0] and ">=" in f.split("\n")[0] for f in plan[joined:].split("Filter ")[1:])
