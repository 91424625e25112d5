"""Audit state that merges, and customers that arrive: nulls, ties, copies, a hot segment, late rows, restarts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from churnlake.catalog.relations import Tables
from churnlake.operators import mergeable
from churnlake.session import scratch_path
from churnlake.streaming import scoring as arriving

SCHEMA = "at timestamp, kind string, who string, v double"
DAY = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = [(DAY + timedelta(hours=rng.randrange(24 * 6)), "hot" if rng.random() < 0.7 else rng.choice(["a", "b"]),
             f"u{rng.randrange(9000)}", rng.choice([rng.gauss(0, 50), 7.0])) for _ in range(20_000)]
    return made + made[:50] + [(None, "a", None, None), (DAY, None, "u1", 1.0), (DAY, None, "u1", 1.0), (DAY, "none", None, None),
                               (DAY, "none", None, float("nan"))]


@pytest.fixture(scope="module")
def state(spark, rows):
    path = scratch_path(spark, "state")
    whole = mergeable.daily_state(spark.createDataFrame(rows, SCHEMA), "at", ["kind"], ["who"], ["v"])
    mergeable.store(whole, path)
    mergeable.store(whole.where(F.col("day") == "2024-03-02"), path)  # a day that is run again
    return mergeable.read_state(spark, path)


def test_merged_days_are_within_the_stated_error(state, rows):
    assert state.count() == len({(r[0] and r[0].date(), r[1]) for r in rows})
    merged = mergeable.merged(state, ["kind"]).select(
        "*", mergeable.distinct_estimate("who").alias("users"), *[mergeable.quantile_estimate("v", p).alias(f"q{p}") for p in (0, 0.5, 0.9, 1)])
    found = {r.kind: r for r in merged.collect()}
    assert set(found) == {r[1] for r in rows}
    for kind, r in found.items():
        mine = [x for x in rows if x[1] == kind]
        values = sorted(x[3] for x in mine if x[3] is not None and x[3] == x[3])
        users = {x[2] for x in mine} - {None}
        assert (r.n, r.who_absent, r.v_nulls) == (len(mine), sum(x[2] is None for x in mine), len(mine) - len(values))
        assert abs(r.users - len(users)) <= mergeable.DISTINCT_ERROR * len(users)
        if not values:
            assert r.v_min is None and r["q0.5"] is None and r.users == 0
            continue
        assert (r.v_min, r.v_max, r["q0"], r["q1"]) == (values[0], values[-1], values[0], values[-1])
        assert float(r.v_sum) == pytest.approx(sum(values), abs=1e-4 * len(values))
        for p in (0.5, 0.9):
            below, upto = sum(v < r[f"q{p}"] for v in values), sum(v <= r[f"q{p}"] for v in values)
            assert below <= (p + mergeable.RANK_ERROR) * len(values) and upto >= (p - mergeable.RANK_ERROR) * len(values)


def test_all_segments_merge_to_one_row(state, rows):
    assert mergeable.merged(state).first().n == len(rows)


def test_no_rows_give_no_state(spark):
    empty = mergeable.daily_state(spark.createDataFrame([], SCHEMA), "at", ["kind"], ["who"], ["v"])
    assert empty.count() == 0 and mergeable.merged(empty, ["kind"]).count() == 0


def test_a_wrong_estimate_is_told(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("low", F.lit(-1000.0)).withColumn("mid", F.lit(7.0))
    for name, good in (("low", False), ("mid", True)):
        assert mergeable.rank_within(df.where("kind = 'hot'"), "v", name, 0.6, ["kind"]).first()[1] is good


@pytest.fixture(scope="module")
def stream_of(spark, folder):
    """A folder to write arrivals to, and a function that scores what is new and returns all that is scored."""
    t = Tables(spark, folder)
    raw = t.raw.withColumn("arrived", F.lit("2024-05-01 10:00:00").cast("timestamp"))
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("inbox", "out", "checkpoint"))

    def arrive(rows):
        rows.write.mode("append").parquet(inbox)
        schema = arriving.score_arrivals(arriving.arrivals(spark, inbox, raw.schema, 1), t.score, out, checkpoint)
        return arriving.read_scored(spark, out, schema)

    assert arriving.read_scored(spark, out, raw.schema).count() == 0
    return t, raw, arrive


def test_arrivals_in_parts_with_copies_late_rows_and_restarts(stream_of):
    t, raw, arrive = stream_of
    key = F.pmod(F.xxhash64("customerID"), F.lit(3))
    batch = {r.customerID: r.p for r in t.scored.collect()}

    first = arrive(raw.where(key == 0).repartition(2))
    assert {r.customerID: r.p for r in first.collect()} == {k: v for k, v in batch.items() if k in {
        r.customerID for r in raw.where(key == 0).collect()}}
    # The next run starts from the checkpoint; half of what arrives is there already.
    second = arrive(raw.where(key <= 1).repartition(3))
    assert second.count() == raw.where(key <= 1).select("customerID").distinct().count()
    assert arrive(raw.limit(0)).count() == second.count()
    # Two days on, then rows of the first day: those are late. A row without a time never counts.
    later = raw.where(key == 2).withColumn("arrived", F.lit("2024-05-04 10:00:00").cast("timestamp"))
    whole = arrive(later)
    assert {r.customerID: r.p for r in whole.collect()} == batch and whole.count() == len(batch)
    late = raw.limit(5).withColumn("TotalCharges", F.lit("1.25"))
    assert arrive(late.withColumn("arrived", F.lit(None).cast("timestamp"))).count() == len(batch)
    assert arrive(late).count() == len(batch)
    fresh = late.withColumn("arrived", F.lit("2024-05-04 11:00:00").cast("timestamp"))
    assert arrive(fresh).count() == len(batch) + fresh.distinct().count()
