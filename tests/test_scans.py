import random

import pytest
from pyspark.sql import functions as F

from hazardline.operators import scans as S

STEPS = {
    "down": S.fill_down("v"),
    "up": S.fill_up("v"),
    "next": S.following("v"),
    "prev": S.preceding("v"),
    "pos": S.position(),
    "run": S.running_sum("n"),
    "rest": S.remaining_sum("n"),
    "prod": S.running_product("f"),
    "top": S.key_max("n"),
}


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(1200):
        key = "hot" if i % 3 else f"k{rnd.randrange(40)}"
        v = None if rnd.random() < 0.7 else f"v{i}"
        rows.append((key, None if i % 97 == 0 else float(i % 613), i, v, rnd.randrange(5), 1 + rnd.random() / 1000))
    return spark.createDataFrame(rows, "k string, o double, tie int, v string, n int, f double").persist()


def collect(df):
    out = df.withColumn("prod", F.round("prod", 9)).orderBy("k", F.col("o").asc_nulls_last(), "tie")
    return [tuple(r) for r in out.select("k", "o", "tie", *STEPS).collect()]


def test_segments_give_the_same_as_one_window(skewed):
    plain = collect(S.ordered_scan(skewed, ["k"], ["o", "tie"], STEPS, bounded=True))
    cut = collect(S.ordered_scan(skewed, ["k"], ["o", "tie"], STEPS, floor=100))
    assert plain == cut


def test_measure_finds_the_heavy_one_only(skewed):
    assert [tuple(r) for r in S.measure_keys(skewed, ["k"], 100).hot.collect()] == [("hot", 800)]
    assert S.measure_keys(skewed, ["k"]).hot is None


def test_scan_without_keys(skewed):
    whole = S.ordered_scan(skewed, [], ["o", "tie"], {"pos": S.position()}, floor=100)
    got = sorted(r["pos"] for r in whole.collect())
    assert got == list(range(1, 1201))
    assert "_all" not in whole.columns


def test_result_does_not_depend_on_partitions(skewed):
    a = collect(S.ordered_scan(skewed.repartition(1), ["k"], ["o", "tie"], STEPS, bounded=True))
    b = collect(S.ordered_scan(skewed.repartition(13), ["k"], ["o", "tie"], STEPS, floor=100))
    assert a == b


def test_first_per_key_mixed_directions(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (1, None, "c"), (2, 1, "d")], "k int, o int, t string")
    got = S.first_per_key(df, ["k"], [("o", "desc"), ("t", "asc")]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 2, "a"), (2, 1, "d")]


def test_broadcast_only_small(spark):
    assert "broadcast" in S.broadcast_small(spark.range(10), 10)._jdf.queryExecution().logical().toString().lower()
    big = S.broadcast_small(spark.range(11), 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in big


@pytest.mark.parametrize("order", ["text", "date", "stamp", "composite", "constant first"])
def test_any_order_is_cut(spark, order):
    rnd = random.Random(order)
    rows = []
    for i in range(900):
        key = None if i % 3 else f"k{rnd.randrange(20)}"  # the large key is null
        v = None if rnd.random() < 0.6 else f"v{i}"
        a = rnd.choice([None, "", "z", "ab" * rnd.randrange(100), "ab" * 70 + str(i)])
        rows.append((key, a, i % 50, "same", i, v, rnd.randrange(5), 1 + rnd.random() / 1000))
    df = spark.createDataFrame(rows, "k string, a string, d int, c string, tie int, v string, n int, f double")
    df = df.withColumns({"date": F.date_add(F.lit("1960-01-01").cast("date"), F.col("d")), "stamp": F.expr("timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(d)")})
    by = {"text": ["a"], "date": ["date"], "stamp": ["stamp"], "composite": ["n", "a", "date"], "constant first": ["c", "a"]}[order] + ["tie"]
    df = df.persist()
    plain = S.ordered_scan(df, ["k"], by, STEPS, bounded=True)
    cut = S.ordered_scan(df, ["k"], by, STEPS, floor=100)
    one, two = (sorted((tuple(r) for r in x.withColumn("prod", F.round("prod", 9)).select("k", "tie", *STEPS).collect()), key=str) for x in (plain, cut))
    assert one == two


def test_pieces_have_an_absolute_size(spark):
    df = spark.range(40_000).select(F.lit("same").alias("c"), F.concat(F.lit("id"), "id").alias("t"))
    place = S._cut_key(df.withColumn("_all", F.lit(1)), ["c", "t"])
    cuts = S._cut_points(df.withColumn("_all", F.lit(1)), ["_all"], place, spark.createDataFrame([(1,)], "_all int"), 1000).first()["_cuts"]
    assert 60 <= len(cuts) <= 100  # about 500 rows each
    ranked = sorted(f"id{i}" for i in range(40_000))
    at = [ranked.index(c["v1_1"]) for c in cuts]
    assert max(b - a for a, b in zip([0, *at], [*at, 40_000], strict=True)) < 1500


def test_measured_once_and_handed_down(skewed, monkeypatch):
    sizes = S.measure_keys(skewed, ["k"], 100)
    plain = collect(S.ordered_scan(skewed, ["k"], ["o", "tie"], STEPS, bounded=True))
    monkeypatch.setattr(S, "measure_keys", lambda *a: pytest.fail("measured again"))
    assert collect(S.ordered_scan(skewed, ["k"], ["o", "tie"], STEPS, sizes=sizes)) == plain
    small = S.KeySizes(("k",), 5000, None)
    S.ordered_scan(skewed, ["k", "n"], ["o", "tie"], {"pos": S.position()}, sizes=small)


def test_pieces_are_found_without_comparing_all_cut_points(spark):
    """Several levels of the search, keys of unlike numbers of cut points, a null key, points equal to rows."""
    of_key = {None: [5 * i for i in range(150)], "a": [3], "b": [7 * i + 1 for i in range(64)]}
    cuts = spark.createDataFrame([(k, [(c,) for c in v]) for k, v in of_key.items()], "_k0 string, _cuts array<struct<o:int>>")
    rows = spark.createDataFrame([(k, o) for k in (*of_key, "small") for o in range(-2, 760, 3)], "k string, o int")
    out = S._numbered_pieces(rows, ["k"], F.struct("o"), cuts)
    assert {"k", "o", "_cut", "_seg"} == set(out.columns)
    for r in out.collect():
        points = of_key.get(r["k"], [])
        assert (r["_cut"], r["_seg"]) == (bool(points), sum(c <= r["o"] for c in points))


def test_a_row_meets_a_few_cut_points_only(spark):
    rows = spark.range(4000).select(F.col("id").alias("o"))
    out = S.ordered_scan(rows, [], ["o"], {"pos": S.position()}, floor=20)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan  # no search through all points of the key
    assert all(r["pos"] == r["o"] + 1 for r in out.collect())
