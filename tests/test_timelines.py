"""Grouping sets, joins in time, sessions, snapshots, cohorts and payloads against plain Python: nulls, ties, copies, hot keys."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from churnlake.operators import asof, cohorts, grouping, overlaps, payloads, sessions, skew, snapshots

START = datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


# ---- grouping sets ----

SETS = [("a", "b"), ("b",), ()]
MEASURES = {"n": ("count", None), "known": ("count", "v"), "total": ("sum", "v"), "mean": ("mean", "v"), "low": ("min", "v"), "high": ("max", "v")}


def test_grouping_sets(spark):
    rows = [("x", 1, 1.5), ("x", 1, 1.5), ("x", None, None), (None, 1, 2.25), (None, None, -4.0), ("y", 2, None), ("y", 2, None)] * 3
    found = grouping.grouping_sets(spark.createDataFrame(rows, "a string, b int, v double"), ["a", "b"], SETS, MEASURES)
    expected = {}
    for keys, code in zip(SETS, (0, 2, 3)):
        groups = defaultdict(list)
        for a, b, v in rows:
            groups[(a if "a" in keys else None, b if "b" in keys else None, code)].append(v)
        for key, values in groups.items():
            known = [v for v in values if v is not None]
            expected[key] = (len(values), len(known), sum(known) if known else None, sum(known) / len(known) if known else None,
                             min(known, default=None), max(known, default=None))
    assert {(r.a, r.b, r.grouping_id): tuple(r[m] for m in MEASURES) for r in found.collect()} == expected


def test_grouping_reads_once(spark):
    """The rows are combined before they are multiplied by the sets."""
    df = spark.range(100).selectExpr("id % 3 AS a", "id % 2 AS b", "double(id) AS v")
    plan = grouping.cube(df, ["a", "b"], MEASURES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.index("Expand") < plan.rindex("HashAggregate") < plan.index("Range (")
    assert grouping.cube(df.limit(0), ["a", "b"], MEASURES).count() == 0
    assert len(grouping.cube_sets("abc")) == 8 and grouping.rollup_sets("abc")[-1] == ()
    with pytest.raises(ValueError):
        grouping.grouping_sets(df, ["a"], [("b",)], MEASURES)
    with pytest.raises(ValueError):
        grouping.rollup(df, ["a"], {"m": ("median", "v")})


# ---- as-of join ----


def brute_asof(left, right, strict, within):
    out = Counter()
    for key, t, name in left:
        best = None
        for k, u, value in right:
            if None not in (key, t, k, u) and k == key and (u < t or (u == t and not strict)):
                if within is None or t - u <= timedelta(microseconds=within):
                    best = max(best or (u, value), (u, value))
        out[(key, t, name, best and best[1])] += 1
    return out


@pytest.mark.parametrize("strict,within,target", [(False, None, 10_000), (True, None, 40), (False, 3_600_000_000, 40), (False, None, 3)])
def test_asof(spark, strict, within, target):
    """A third of all rows on one key, equal times on both sides, copies, null keys and times."""
    luck = random.Random(target)
    keys = [1] * 200 + [2, 3, 4, None] * 30
    left = [(k, at(luck.choice([None, *range(0, 600, 3)])), f"l{i}") for i, k in enumerate(keys)]
    right = [(luck.choice([1, 1, 1, 2, 3, None]), at(luck.choice([None, *range(0, 900, 5)])), i) for i in range(250)]
    left, right = left + left[:20], right + right[:20]
    l = spark.createDataFrame(left, "key int, t timestamp_ntz, name string")
    r = spark.createDataFrame(right, "k int, u timestamp_ntz, value int")
    found = asof.asof_join(l, r, [("key", "k")], "t", "u", ["value"], ties=["value"], strict=strict, within=within, target=target)
    assert Counter(map(tuple, found.collect())) == brute_asof(left, right, strict, within)


def test_asof_edges(spark):
    l = spark.createDataFrame([(1, 5, "a")], "key int, t int, name string")
    r = spark.createDataFrame([(1, 4, 1)], "k int, u int, value int")
    join = lambda a, b: asof.asof_join(a, b, [("key", "k")], "t", "u", ["value"]).collect()
    assert join(l.limit(0), r) == [] and [tuple(x) for x in join(l, r.limit(0))] == [(1, 5, "a", None)]
    assert [tuple(x) for x in join(l, r)] == [(1, 5, "a", 1)]
    with pytest.raises(ValueError, match="both"):
        asof.asof_join(l, r.withColumnRenamed("value", "name"), [("key", "k")], "t", "u", ["name"])


def test_asof_spreads_hot_key(spark):
    """No slice of the hot key holds much more than the target."""
    from churnlake.operators import timeslices

    df = spark.range(20_000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id * id AS t")
    hot = timeslices.hot_keys(df, ["k"], "t", 500)
    sizes = [r["count"] for r in timeslices.sliced(df, hot, ["k"], "t").where("_hot").groupBy("_slice").count().collect()]
    assert len(sizes) >= 10 and sum(sizes) == 6668 and max(sizes) <= 600


# ---- interval join ----


def brute_overlaps(left, right):
    return Counter((x, y) for x in left for y in right if None not in x[:3] and None not in y[:3]
                   and x[0] == y[0] and x[1] <= x[2] and y[1] <= y[2] and x[1] <= y[2] and y[1] <= x[2])


@pytest.mark.parametrize("seed", range(4))
def test_intervals(spark, seed):
    """Lengths from a point to the whole range, negative bounds, nulls, bounds the wrong way round, copies."""
    luck = random.Random(seed)

    def some(n):
        out = []
        for i in range(n):
            a = luck.choice([None, *range(-500, 500)])
            length = luck.choice([0, 1, 3, 10, 10, 40, 300, 5000 if seed else 12, -2])
            out.append((luck.choice([1, 1, 2, None]), a, None if a is None or luck.random() < 0.05 else a + length, i))
        return out + out[:15]

    left, right = some(120), some(90)
    schema = "key int, a bigint, b bigint, i int"
    l, r = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    found = overlaps.interval_join(l, r, ("a", "b"), ("a", "b"), on=[("key", "key")])
    assert Counter((tuple(p.l), tuple(p.r)) for p in found.collect()) == brute_overlaps(left, right)
    whole = overlaps.interval_join(l.withColumn("key", F.lit(1)), r.withColumn("key", F.lit(1)), ("a", "b"), ("a", "b"))
    one = [(1, *x[1:]) for x in left], [(1, *x[1:]) for x in right]
    assert Counter((tuple(p.l), tuple(p.r)) for p in whole.collect()) == brute_overlaps(*one)


def test_intervals_plan_and_edges(spark):
    df = spark.range(50).selectExpr("id AS a", "id + 2 AS b")
    pairs = overlaps.interval_join(df, df, ("a", "b"), ("a", "b"))
    assert "NestedLoop" not in (plan := pairs._jdf.queryExecution().executedPlan().toString()) and "Cartesian" not in plan
    assert pairs.count() == 50 + 2 * 49 + 2 * 48
    assert overlaps.interval_join(df.limit(0), df, ("a", "b"), ("a", "b")).count() == 0
    assert overlaps.interval_join(df.limit(0), df.limit(0), ("a", "b"), ("a", "b")).count() == 0


# ---- skewed join ----


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
def test_skew_join(spark, how):
    """A third of the rows on one key, a third of the rest copies of one row, null keys on both sides, two rows per key."""
    big = [(7, f"r{i}") for i in range(300)] + [(7, "copy")] * 200 + [(i % 40, f"s{i}") for i in range(300)] + [(None, "n")] * 150
    other = [(7, 70), (7, 71), (3, 30), (None, 0), (5, None), (99, 1)]
    found = skew.skew_join(spark.createDataFrame(big, "k int, name string"), spark.createDataFrame(other, "key long, value int"),
                           [("k", "key")], ["value"], how, rows=50)
    expected = Counter()
    for k, name in big:
        hits = [v for key, v in other if k is not None and key == k]
        if how == "semi":
            expected[(k, name)] += bool(hits)
        elif how == "anti":
            expected[(k, name)] += not hits
        else:
            for v in hits or ([None] if how == "left" else []):
                expected[(k, name, v)] += 1
    assert Counter(map(tuple, found.collect())) == +expected


def test_skew_join_spreads_a_hot_customer(spark, folder):
    """With a third of the orders on one customer, no task of the join gets more than three times the median."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").selectExpr(
        "o_orderkey", "IF(o_orderkey % 3 = 0, 5L, o_custkey) AS c").crossJoin(spark.range(8).withColumnRenamed("id", "copy"))
    customers = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_mktsegment")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        def sizes(df):
            return [r[1] for r in sorted(df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).collect())]

        plain = sizes(orders.join(customers, F.col("c") == F.col("c_custkey")))
        dealt = sizes(skew.skew_join(orders, customers, [("c", "c_custkey")], ["c_mktsegment"], rows=100))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(plain) == sum(dealt) == 12_000 and max(plain) > 3 * sorted(plain)[4]
    rest, hot = dealt[:8], dealt[8:]  # two joins of eight tasks each
    assert len(hot) == 8 and sum(hot) >= 4000 and max(hot) <= 3 * sorted(hot)[4] and max(rest) <= 3 * sorted(rest)[4]


def test_skew_join_edges(spark):
    l, r = spark.createDataFrame([(1, "a")], "k int, name string"), spark.createDataFrame([(1, 2)], "key int, value int")
    assert skew.skew_join(l.limit(0), r, [("k", "key")], ["value"]).collect() == []
    assert [tuple(x) for x in skew.skew_join(l, r.limit(0), [("k", "key")], ["value"], "left").collect()] == [(1, "a", None)]
    with pytest.raises(ValueError, match="unknown join"):
        skew.skew_join(l, r, [("k", "key")], ["value"], "full")
    with pytest.raises(ValueError, match="both"):
        skew.skew_join(l, r.withColumnRenamed("value", "name"), [("k", "key")], ["name"])


# ---- gaps and islands ----


@pytest.mark.parametrize("target", [100_000, 50, 2])
def test_islands(spark, target):
    luck = random.Random(target)
    rows = [(luck.choice([1, 1, 1, 1, 2, 3, None]), at(luck.choice([None, *range(0, 5000, 7)])), luck.choice([None, 1.25, 2.5])) for _ in range(900)]
    rows += rows[:30]
    found = sessions.islands(spark.createDataFrame(rows, "k int, t timestamp_ntz, v double"), ["k"], "t", 20 * 60_000_000,
                             {"total": ("sum", "v"), "known": ("count", "v"), "top": ("max", "v")}, target=target)
    expected = Counter()
    by_key = defaultdict(list)
    for k, t, v in rows:
        if t is not None:
            by_key[k].append((t, v))
    for k, values in by_key.items():
        values.sort(key=lambda x: x[0])
        runs = []
        for t, v in values:
            if not runs or t - runs[-1][-1][0] > timedelta(minutes=20):
                runs.append([])
            runs[-1].append((t, v))
        for i, run in enumerate(runs):
            known = [v for _, v in run if v is not None]
            idle = (run[0][0] - runs[i - 1][-1][0]) // timedelta(microseconds=1) if i else None
            expected[(k, run[0][0], run[-1][0], len(run), idle, sum(known) if known else None, len(known), max(known, default=None))] += 1
    assert Counter(map(tuple, found.collect())) == expected
    assert sessions.islands(spark.createDataFrame([], "k int, t timestamp_ntz"), ["k"], "t", 5).collect() == []


# ---- snapshots ----


def test_snapshots(spark):
    """Nulls change places, zeros have signs, copies differ in number, nested values hold nulls."""
    shape = "k int, a string, b string, c array<int>, d double"
    before = [(1, None, "x", [1, None], 0.5), (1, None, "x", [1, None], 0.5), (2, "x", None, None, None), (3, "same", "s", [], 1.0),
              (3, "same", "s", [], 1.0), (4, "gone", None, None, 2.0), (None, "n", "n", None, None), (6, "u", "v", None, 1.0), (6, "w", "v", None, 1.0)]
    after = [(1, "x", None, [1, None], 0.5), (2, "x", None, None, None), (3, "same", "s", [], 1.0), (3, "same", "s", [], 1.0),
             (3, "same", "s", [], 1.0), (5, "new", None, [None, 1], 3.0), (None, "n", "m", None, None), (6, "u", "v", None, 2.0)]
    b, a = spark.createDataFrame(before, shape), spark.createDataFrame(after, shape).select("d", "c", "b", "a", "k")

    def counted(rows):
        return Counter((r[0], r[1], r[2], None if r[3] is None else tuple(r[3]), r[4]) for r in rows)

    cb, ca = counted(before), counted(after)
    more = {tuple(x[:3]) + (None if x[3] is None else tuple(x[3]), x[4]): x.copies for x in snapshots.except_all(b, a).collect()}
    both = {tuple(x[:3]) + (None if x[3] is None else tuple(x[3]), x[4]): x.copies for x in snapshots.intersect_all(b, a).collect()}
    assert more == dict(cb - ca) and both == dict(cb & ca)
    assert counted(snapshots.expanded(snapshots.except_all(b, a)).collect()) == cb - ca
    found = {r.k: tuple(r)[1:] for r in snapshots.changes(b, a, ["k"]).collect()}
    assert found == {1: ("changed", 2, 1, "a,b"), 3: ("added", 0, 1, None), 4: ("removed", 1, 0, None), 5: ("added", 0, 1, None),
                     None: ("changed", 1, 1, "b"), 6: ("changed", 2, 1, None)}
    with pytest.raises(ValueError, match="columns differ"):
        snapshots.except_all(b, a.drop("d"))


def test_snapshot_edges(spark):
    df = spark.range(30).selectExpr("id % 3 AS k")
    none = df.limit(0)
    assert snapshots.except_all(none, df).collect() == [] and snapshots.intersect_all(df, none).collect() == []
    assert sorted(map(tuple, snapshots.except_all(df, none).collect())) == [(0, 10), (1, 10), (2, 10)]
    many = spark.createDataFrame([("x", 25_001)], "name string, copies long")
    assert snapshots.expanded(many).count() == 25_001


# ---- cohorts ----


def test_retention(spark):
    rows = [(1, "2023-11-05"), (1, "2023-11-06"), (1, "2024-02-01"), (2, "2024-01-31"), (2, "2024-02-29"), (3, "2024-02-10"), (None, "2020-01-01"), (4, None)]
    df = spark.createDataFrame(rows * 2, "k int, d string").withColumn("d", F.col("d").cast("date"))
    found = {(r.cohort, r.age): (r.customers, r.active, r.retention) for r in cohorts.retention(df, "k", "d").collect()}
    assert len(found) == 4 + 3 + 2 + 1
    assert found["2023-11", 0] == (1, 1, 100.0) and found["2023-11", 3] == (1, 1, 100.0) and found["2023-11", 1] == (1, 0, 0.0)
    assert found["2023-12", 2] == (0, 0, None) and found["2024-01", 1] == (1, 1, 100.0) and found["2024-02", 0] == (1, 1, 100.0)
    assert cohorts.retention(df.limit(0), "k", "d").collect() == []


def test_survival(spark):
    """Ties of leaving and end of watching, a curve that reaches zero, nulls."""
    rows = [("a", 1, 1), ("a", 1, 0), ("a", 2, 1), ("a", 2, 1), ("a", 3, 0), ("b", 1, 0), ("b", 5, 1), (None, 4, 0), ("a", None, 1), ("a", 2, None)]
    found = {(r.g, r.duration): tuple(r)[2:] for r in cohorts.survival(spark.createDataFrame(rows, "g string, t int, e int"), "t", "e", ["g"]).collect()}
    assert found["a", 1] == (5, 1, 1, 0.8, round((0.64 * (1 / 20)) ** 0.5, 6))
    assert found["a", 2][:4] == (3, 2, 0, round(0.8 / 3, 6)) and found["a", 3][:4] == (1, 0, 1, round(0.8 / 3, 6))
    assert found["b", 1][:4] == (2, 0, 1, 1.0) and found["b", 5] == (1, 1, 0, 0.0, None) and found[None, 4][3] == 1.0


# ---- payloads ----


def test_payloads(spark):
    texts = ['{"k": 1, "s": "x", "f": 1.5, "l": [1, null], "more": {}}', None, "", "{", "[1]", '{"k": "1", "s": 2}', '{"k": 1.5}', '{"k": null}', "{}",
             '{"k": 99999999999999999999, "s": "a"}', '{"k": 3, "l": ["x"]}', '{"k": 3, "l": []}', '{"k": 3, "f": 2, "s": null}', '{"k": 1, "k": 2}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, body string")
    parsed = payloads.parse(df, "body", {"k": "bigint", "s": "string", "f": "double", "l": "array<bigint>"}, required=["k"])
    found = {r.i: r for r in parsed.collect()}
    assert len(found) == len(texts)
    assert (found[0].k, found[0].s, found[0].f, found[0].l, found[0].problem) == (1, "x", 1.5, [1, None], None)
    assert [found[i].problem for i in range(1, 9)] == ["absent", "malformed", "malformed", "no object", "type of k", "type of k", "no k", "no k"]
    assert found[5].s is None and found[9].problem == "type of k" and found[9].s == "a" and found[10].problem == "type of l"
    assert found[11].l == [] and found[12].f == 2.0 and found[12].problem is None
    assert found[13].problem == "malformed"  # a name twice
    assert sum(r.n for r in payloads.problems(parsed).collect()) == len(texts)
    folds = payloads.folded(parsed, "l", {"n": "n", "total": "sum", "mean": "mean", "least": "least"})
    by_row = {r.i: (r.n, r.total, r.mean, r.least) for r in folds.collect()}
    assert by_row[0] == (1, 1.0, 1.0, 1) and by_row[11] == (0, 0.0, None, None) and by_row[1] == (None, None, None, None)
    assert payloads.problems(payloads.parse(df.limit(0), "body", {"k": "int"})).collect() == []
    with pytest.raises(ValueError, match="exist"):
        payloads.parse(df, "body", {"i": "int"})


def test_map_totals(spark):
    df = spark.createDataFrame([("a", {"x": 1.5, "y": None}), ("a", {"x": 2.0}), (None, {"x": 1.0}), ("b", None), ("b", {})], "g string, m map<string,double>")
    found = {(r.g, r.name): (r.n, r.total) for r in payloads.map_totals(df, ["g"], "m").collect()}
    assert found == {("a", "x"): (2, 3.5), ("a", "y"): (1, None), (None, "x"): (1, 1.0)}
