"""Operators on small tables with written-out results."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.functions import scalars as fn
from tarnwork.operators import aggregate, cdc, joins, nested, nulls, project, quality, timeseries, window
from tarnwork.sources import readers, writers

D = dt.date
TS = dt.datetime


# -- tables from rows ---------------------------------------------------------------


def test_literal_tables(spark, rows):
    inferred = readers.literal_table(spark, [(1, "x", 2.5)], ["id", "name", "price"])
    assert inferred.dtypes == [("id", "bigint"), ("name", "string"), ("price", "double")]
    fixed = readers.literal_table(
        spark, [(1, ["a"])], T.StructType().add("id", T.IntegerType()).add("xs", T.ArrayType(T.StringType()))
    )
    assert fixed.dtypes == [("id", "int"), ("xs", "array<string>")]
    assert rows(readers.literal_table(spark, [Row(a=1, b="x"), Row(a=2, b=None)])) == [(1, "x"), (2, None)]
    assert readers.literal_table(spark, [{"a": 1, "b": {"c": "x"}}]).dtypes[1] == ("b", "map<string,string>")
    assert rows(readers.literal_table(spark, ["one", "two"], "string").toDF("line")) == [("one",), ("two",)]
    listing = readers.describe_columns(inferred)
    assert rows(listing)[2] == (2, "price", "double")
    assert rows(readers.id_range(spark, 2, 5)) == [(2,), (3,), (4,)]
    assert rows(readers.param_table(spark, "tarnwork.unset", "NA", "v")) == [("NA",)]
    spark.conf.set("tarnwork.isset", "it's")
    assert rows(readers.param_table(spark, "tarnwork.isset", "NA", "v")) == [("it's",)]
    assert rows(readers.row_count(inferred)) == [(1,)]


# -- projections ---------------------------------------------------------------------


def test_projection_routes(spark, rows):
    df = spark.createDataFrame([("reed", "C", 5), ("brass", "Bb", 7)], ["family", "key", "pipes"])
    renamed = project.rename(df, {"family": "Stop Family", "key": "Pitch"})
    assert renamed.columns == ["Stop Family", "Pitch", "pipes"] and rows(renamed) == rows(df)
    assert project.reorder(renamed, ["pipes", "Pitch", "Stop Family"]).columns[0] == "pipes"
    assert project.prefix_columns(df, "organ_").columns == ["organ_family", "organ_key", "organ_pipes"]
    assert project.columns_of_type(df, T.NumericType) == ["pipes"]
    assert [project.snake_case(c) for c in ("windPressure", "rankOfPipes", "key")] == ["wind_pressure", "rank_of_pipes", "key"]
    assert project.snake_case_columns(spark.createDataFrame([(1, 2)], ["swellBox", "stop"])).columns == ["swell_box", "stop"]
    ids = [r[0] for r in project.row_id(df.repartition(3)).select("row_id").collect()]
    assert len(set(ids)) == 2


def test_text_compared_as_a_number(spark, rows):
    df = spark.createDataFrame([("9",), ("10.5",), ("n/a",), ("",), (None,), (" 11 ",), ("1e2",), ("NaN",)], "t string")
    assert rows(project.where_number(df, "t", ">", 9)) == [(" 11 ",), ("10.5",), ("1e2",), ("NaN",)]
    assert rows(project.where_number(df, "t", "<=", 10.5)) == [("10.5",), ("9",)]
    assert rows(project.where_number(df, "t", "<>", 9)) == [(" 11 ",), ("10.5",), ("1e2",), ("NaN",)]
    with pytest.raises(KeyError):
        project.where_number(df, "t", "~", 1)


def test_catalogue_of_a_schema(spark, tmp_path, rows):
    schema = f"catalogue_{tmp_path.name}".replace("-", "_")
    writers.create_schema(spark, schema, "it's a \\ schema")
    assert spark.catalog.getDatabase(schema).description == "it's a \\ schema"
    writers.save_table(spark.range(2), f"{schema}.one", path=str(tmp_path / "one"))
    spark.sql(f"ALTER TABLE {schema}.one SET TBLPROPERTIES ('layer' = 'raw')")
    spark.sql(f"COMMENT ON TABLE {schema}.one IS 'first'")
    spark.range(1).createOrReplaceTempView(f"view_{schema}")
    got = readers.catalogue(spark, schema, ["layer", "missing"])
    assert got.columns == ["table_name", "kind", "is_view", "comment", "layer", "missing"]
    assert rows(got.where("not is_view")) == [("one", "EXTERNAL", False, "first", "raw", None)]
    assert rows(got.where("is_view"), "table_name").count((f"view_{schema}",)) == 1


def test_nested_fields_two_spellings(spark, rows):
    df = spark.createDataFrame(
        [(1, {"city": "Graz", "state": "ST"}), (2, {"city": "Linz"})], "id int, address map<string,string>"
    )
    by_dots = project.flatten(df, {"city": "address.city", "state": "address.state"}, ["id"])
    by_index = df.select("id", df["address"]["city"].alias("city"), df["address"]["state"].alias("state"))
    assert rows(by_dots) == rows(by_index) == [(1, "Graz", "ST"), (2, "Linz", None)]


def test_label_takes_the_first_branch_that_holds(spark):
    df = spark.createDataFrame([(-1,), (0,), (7,), (8,), (None,)], "n int")
    out = project.label(df, "sign", [(F.col("n") < 0, "minus"), ("n < 8", "few"), ("n IS NULL", "none")], "many")
    assert dict(out.collect()) == {-1: "minus", 0: "few", 7: "few", 8: "many", None: "none"}
    assert {r["sign"] for r in project.label(df, "sign", [], "all").collect()} == {"all"}


def test_filters(spark, rows):
    df = spark.createDataFrame(
        [(1, "IT", 80000), (2, "it", 60000), (3, None, 90000), (4, "HR", None)], "id int, dep string, pay int"
    )
    assert rows(project.where(df, (F.col("dep") == "IT") & (F.col("pay") > 70000)), "id") == [(1,)]
    assert rows(project.where_ci(df, "dep", "It"), "id") == [(1,), (2,)]
    assert rows(project.where(df, F.col("dep") != "IT"), "id") == [(2,), (4,)]  # NULL drops
    assert rows(project.where(df, "pay is null or dep is null"), "id") == [(3,), (4,)]


# -- joins ----------------------------------------------------------------------------


@pytest.fixture()
def people(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (2, "xx"), (3, "y"), (None, "z")], "k int, r string")
    return left, right


def test_full_join_split_equals_single_join(people, rows):
    l, r = people
    split, single = joins.full_join(l, r, "k"), joins.full_join(l, r, "k", split=False)
    assert split.columns == single.columns == ["k", "l", "r"]
    assert rows(split) == rows(single)
    assert len(rows(split)) == 4 + 1 + 1 + 2
    other = r.withColumnRenamed("k", "rk")
    assert rows(joins.full_join(l, other, {"k": "rk"})) == rows(
        joins.full_join(l, other, {"k": "rk"}, split=False)
    )


def test_unmatched_routes_agree(people, rows):
    l, r = people
    assert rows(joins.unmatched(l, r, "k")) == rows(joins.unmatched(l, r, "k", via="outer"))
    assert rows(joins.unmatched(l, r, "k"), "l") == [("a",), ("n",)]


def test_unmatched_on_key_and_date(spark, rows):
    # The date is used by another user, which must not hide u1's hole.
    want = spark.createDataFrame([("u1", D(2024, 1, 3)), ("u2", D(2024, 1, 3))], "u string, d date")
    have = spark.createDataFrame([("u2", D(2024, 1, 3))], "u string, day date")
    assert rows(joins.unmatched(want, have, {"u": "u", "d": "day"})) == [("u1", D(2024, 1, 3))]


def test_salted_join_equals_plain_join(spark, rows):
    fact = spark.createDataFrame(
        [(7, i % 3, 1.0) for i in range(50)] + [(1, 0, 2.0), (9, 0, 3.0), (None, 0, 4.0)], "k int, p int, v double"
    ).repartition(4)
    dim = spark.createDataFrame([(7, "seven"), (1, "one"), (2, "two")], "k int, name string")
    for how in ("left", "inner", "right", "full", "left_semi", "left_anti"):
        assert rows(joins.salted_join(fact, dim, "k", 4, how)) == rows(fact.join(dim, "k", how))


def test_broadcast_is_checked(spark, rows):
    big = spark.range(2000)
    assert joins.fits_broadcast(big)
    assert not joins.fits_broadcast(big, max_rows=1999)
    assert not joins.fits_broadcast(big, max_bytes=1000)
    l = spark.range(5)
    assert rows(joins.join(l, big, "id", broadcast=True)) == rows(l.join(big, "id"))


@pytest.mark.parametrize("pack", [1, 7, 1000, 5000, 6000])
def test_cross_of_any_size(spark, rows, pack):
    l = spark.createDataFrame([("a",), ("b",), (None,)], "s string").repartition(2)
    r = spark.range(5000 if pack > 100 else 40).withColumn("v", F.when(F.col("id") % 7 > 0, F.col("id"))).repartition(3)
    got = joins.cross(l, r, pack)
    assert got.columns == ["s", "id", "v"]
    want = l.crossJoin(r)
    sums = [F.count(F.lit(1)), F.sum("id"), F.count("v"), F.sum(F.xxhash64("s", "id", "v") % 1000)]
    assert got.agg(*sums).first() == want.agg(*sums).first()
    assert joins.cross(l, r.limit(0), pack).count() == 0


def test_full_join_lays_hot_keys_out_as_grids(spark, rows):
    left = [(7, i) for i in range(60)] + [(None, i) for i in range(30)] + [(1, 0), (2, 1), (3, 1), (3, 1)] + [(8, 5)] * 25
    right = [(7, -i) for i in range(45)] + [(None, -1)] * 20 + [(2, 9), (4, 0), (3, 2)] + [(9, i) for i in range(31)]
    l = spark.createDataFrame(left, "k int, v int").repartition(5)
    r = spark.createDataFrame(right, "k long, w int").repartition(3)
    plain = l.join(r, "k", "full")
    for hot_rows in (1, 4, 20, 10_000):
        cut = joins.full_join(l, r, "k", hot_rows=hot_rows)
        assert cut.columns == plain.columns and rows(cut) == rows(plain)
    q = r.withColumnRenamed("k", "j")
    both = joins.full_join(l, q, {"k": "j"}, hot_rows=4)
    assert rows(both) == rows(l.join(q, F.col("k") == F.col("j"), "full"))
    assert rows(joins.full_join(l.limit(0), r, "k", hot_rows=4)) == rows(l.limit(0).join(r, "k", "full"))


def test_resolve_parent(spark, rows):
    df = spark.createDataFrame([(1, "Ann", None), (2, "Bob", 1), (3, "Cid", 9)], "id int, name string, boss int")
    assert rows(joins.resolve_parent(df, "id", "boss", "name"), "name", "parent_name") == [
        ("Ann", None), ("Bob", "Ann"), ("Cid", None),
    ]


def test_reconcile(spark, rows):
    a = spark.createDataFrame([(1, "x", 10.0), (2, "y", 20.0)], "id int, name string, spent double")
    b = spark.createDataFrame([(2, "y", 25.0), (3, "z", 30.0)], "id int, name string, spent double")
    defaults = {p + c: v for p in ("a_", "b_") for c, v in (("id", 0), ("name", "n/a"), ("spent", 0.0))}
    assert rows(joins.reconcile(a, b, "id", "a_", "b_", defaults)) == [
        (0, "n/a", 0.0, 3, "z", 30.0), (1, "x", 10.0, 0, "n/a", 0.0), (2, "y", 20.0, 2, "y", 25.0),
    ]


# -- aggregates ---------------------------------------------------------------------------


def test_counts_and_having(spark, rows):
    df = spark.createDataFrame([("a", 1, 999), ("a", None, 1), ("b", 2, 1000), ("c", 3, 1001)], "k string, v int, s int")
    out = aggregate.group(
        df, ["k"], {"n": F.count("v"), "all": F.count("*"), "total": F.sum("s")}, having="total >= 1001"
    )
    assert rows(out) == [("c", 1, 1, 1001)]
    assert rows(aggregate.group(df, ["k"], {"n": F.count("v"), "all": F.count("*")})) == [
        ("a", 1, 2), ("b", 1, 1), ("c", 1, 1),
    ]


def test_top_groups_two_routes(spark, rows):
    data = [(71, 8, 12.5, "2021-05-02"), (72, 9, 40.0, "2021-05-09"), (73, 8, 90.0, "2021-07-30"), (74, 5, 64.0, "2021-06-11")]
    df = spark.createDataFrame(data, "id int, u int, amount double, d string")
    direct = aggregate.top_groups(df, ["u"], {"total": F.sum("amount"), "last": F.max("d")}, ["-total"], 2)
    joined = aggregate.top_groups(df, ["u"], {"total": F.sum("amount")}, ["-total"], 2).join(
        window.latest(df.select("u", F.col("d").alias("last")), ["u"], ["last"]), "u"
    )
    assert rows(direct) == rows(joined) == [(5, 64.0, "2021-06-11"), (8, 102.5, "2021-07-30")]


def test_pivot_and_share(spark, rows):
    df = spark.createDataFrame([("p", "East", 30), ("p", "West", 10), ("q", "East", 5), ("p", "East", 20)], "p string, r string, s int")
    wide = aggregate.pivot(df, ["p"], "r", ["East", "West"], "s")
    assert rows(wide) == [("p", 50, 10), ("q", 5, None)]
    assert rows(aggregate.pivot(df, ["p"], "r", None, "s", "max")) == [("p", 30, 10), ("q", 5, None)]
    assert rows(aggregate.pivot_share(wide, ["East", "West"], 2)) == [("p", 50, 10, 60, 83.33, 16.67), ("q", 5, None, None, None, None)]
    assert rows(aggregate.pivot_share(wide, ["East", "West"], 2, null_as_zero=True))[1][3:] == (5, 100.0, 0.0)
    back = aggregate.unpivot(wide, ["p"], ["East", "West"], "r", "s")
    assert rows(back) == [("p", "East", 50), ("p", "West", 10), ("q", "East", 5), ("q", "West", None)]


def test_correlation(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 3, 30), ("b", 1, 3), ("b", 2, 1)], "k string, x int, y int")
    assert dict(aggregate.correlation(df, "x", "y", ["k"]).collect()) == {"a": 1.0, "b": -1.0}


@pytest.mark.parametrize(
    "values, expected",
    [
        ([41, 60, 44, 57], 44.0),
        ([5], 5.0),
        ([1, 1, 1, 9, 9], 1.0),
        ([None, 3, None], 3.0),
        ([None], None),
        ([7, 2, 9], 7.0),
    ],
)
def test_median_is_an_element(spark, values, expected):
    df = spark.createDataFrame([(v, float("nan")) for v in values], "a int, b double")
    assert tuple(aggregate.median(df, ["a", "b"]).first()) == (expected, None)


def test_median_equals_exact_quantile(spark, monkeypatch):
    df = spark.range(5001).selectExpr("pow(id % 977, 2) as a", "(id * 7919) % 5003 as b", "-id / 3 as c")
    want = [df.approxQuantile(c, [0.5], 0.0)[0] for c in "abc"]
    assert list(aggregate.median(df, ["a", "b", "c"]).first()) == want
    # The number of buckets must not change the result.
    monkeypatch.setattr(aggregate, "_BUCKETS", 16)
    assert list(aggregate.median(df, ["a", "b", "c"]).first()) == want


def test_median_of_wild_doubles(spark, monkeypatch):
    rnd = random.Random(4)
    odd = [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf, math.nan, None, 1.0, 1.0 + 2**-52]
    cases = [
        [rnd.choice(odd) for _ in range(60)],
        [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300) for _ in range(60)],
        [1.0 + k * 2**-52 for k in range(60)],
        [math.inf] * 30 + [-math.inf] * 30,
        [None, math.nan] * 30,
        [7.0] * 59 + [None],
    ]
    df = spark.createDataFrame(list(zip(*cases)), ", ".join(f"c{i} double" for i in range(len(cases)))).repartition(3)
    want = []
    for values in cases:
        known = sorted(v for v in values if v is not None and not math.isnan(v))
        want.append(known[(len(known) + 1) // 2 - 1] if known else None)
    for buckets in (8, 1 << 16):
        monkeypatch.setattr(aggregate, "_BUCKETS", buckets)
        assert list(aggregate.median(df, df.columns).first()) == want


def test_implode(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "z", 1), (1, "c", 3)], "k int, v string, o int")
    assert rows(aggregate.implode(df, ["k"], "v", ["o"])) == [(1, ["a", "b", "c"]), (2, ["z"])]
    chunks = aggregate.implode(df, ["k"], "v", ["o"], chunk=2, hot_rows=1)
    assert rows(chunks) == [(1, 0, ["a", "b"]), (1, 1, ["c"]), (2, 0, ["z"])]


def test_word_count(spark, rows):
    df = spark.createDataFrame(["to be or", "not to be", "a  b"], "string").toDF("line")
    assert dict(aggregate.word_count(df, "line").collect()) == {"to": 2, "be": 2, "or": 1, "not": 1, "a": 1, "": 1, "b": 1}


def test_sum_nested_two_routes(spark, rows):
    data = [(1, [{"amount": 5}, {"amount": 7}]), (2, [{"amount": 1}, {"other": 9}]), (1, [{"amount": 3}]), (3, []), (4, None), (5, [{"other": 1}])]
    df = spark.createDataFrame(data, "u int, t array<map<string,bigint>>")
    by_rows = aggregate.sum_nested(df, ["u"], "t", "amount")
    exploded = nested.explode(df, "t", "x").groupBy("u").agg(F.sum("x.amount").alias("total"))
    assert rows(by_rows) == rows(exploded) == [(1, 15), (2, 1), (5, None)]


def test_group_stats_keep_null_keys(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "k string, v int")
    out = aggregate.with_group_stats(df, ["k"], {"m": F.avg("v")})
    assert rows(out) == [(None, 5, 5.0), ("a", 1, 2.0), ("a", 3, 2.0)]


# -- windows ------------------------------------------------------------------------------


def test_first_rows_of_groups(spark, rows):
    df = spark.createDataFrame([("M", "s", 31), ("M", "t", 47), ("M", "u", 47), ("N", "v", 90), ("N", "w", 12)], "c string, p string, a int")
    assert rows(window.top_n(df, ["c"], ["-a", "p"], 2, "row_number")) == [
        ("M", "t", 47, 1), ("M", "u", 47, 2), ("N", "v", 90, 1), ("N", "w", 12, 2),
    ]
    assert rows(window.group_max_rows(df, ["c"], "a")) == [("M", "t", 47), ("M", "u", 47), ("N", "v", 90)]
    assert rows(window.latest(df, ["c"], ["a", "p"])) == [("M", "u", 47), ("N", "v", 90)]
    assert rows(window.earliest(df, ["c"], ["a", "p"])) == [("M", "s", 31), ("N", "w", 12)]
    assert rows(window.top_ranked(df, ["-a"], 2)) == [("M", "t", 47, 2), ("M", "u", 47, 2), ("N", "v", 90, 1)]


def test_many_first_rows(spark, rows):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    got = window.top_n(df, ["k"], ["-v"], 150, "n")
    assert got.count() == 450 and got.agg(F.min("v")).first()[0] == 1000 - 450
    assert dict(got.dtypes)["n"] == "int"


def test_rows_with_maps_can_be_hashed(spark, rows):
    df = spark.createDataFrame([(1, {"a": "x"}, 1), (1, {"a": "y"}, 2)], "k int, m map<string,string>, s int")
    assert [r[1] for r in rows(cdc.scd1(df, ["k"], "s"))] == [{"a": "y"}]
    dim = spark.createDataFrame([(1, "one")], "k int, n string")
    assert joins.salted_join(df, dim, "k", 3).count() == 2


def test_first_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = window.latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_running_frames_on_ties(spark, rows):
    df = spark.createDataFrame([("m", 1, 10), ("m", 1, 20), ("m", 2, 5)], "k string, t int, v int")
    by_range = window.running_sum(df, ["k"], ["t"], "v", "s")
    assert rows(by_range) == [("m", 1, 10, 30), ("m", 1, 20, 30), ("m", 2, 5, 35)]
    by_rows = window.running_sum(df, ["k"], ["t", "v"], "v", "s", "rows")
    assert rows(by_rows) == [("m", 1, 10, 10), ("m", 1, 20, 30), ("m", 2, 5, 35)]


def test_extremes_two_forms(spark, rows):
    df = spark.createDataFrame([(1, 810), (2, 975), (3, 640), (4, 975)], "id int, pay int")
    names = {"max": "Highest", "min": "Lowest"}
    case = window.extremes(df, "pay", names, "kind")
    assert rows(case) == rows(window.extremes_union(df, "pay", names, "kind")) == [
        (2, 975, "Highest"), (3, 640, "Lowest"), (4, 975, "Highest"),
    ]


# -- time series ------------------------------------------------------------------------------


def test_sessions_keep_exactly_thirty_minutes(spark, rows):
    at = lambda h, m: TS(2024, 1, 1, h, m)
    data = [("u1", at(7, 2)), ("u1", at(7, 17)), ("u1", at(7, 47)), ("u1", at(8, 18)), ("u2", at(6, 5))]
    df = spark.createDataFrame(data, "u string, ts timestamp_ntz")
    assert rows(timeseries.session_summary(df, "u", "ts", 30)) == [
        ("u1", 1, at(7, 2), at(7, 47), 3), ("u1", 2, at(8, 18), at(8, 18), 1), ("u2", 1, at(6, 5), at(6, 5), 1),
    ]
    assert [r[-1] for r in rows(timeseries.gap_flag(df, "u", "ts", 30))] == [1, 1, 2, 2, 1]


def test_streaks(spark, rows):
    days = [10, 11, 12, 15, 18, 19]
    df = spark.createDataFrame([("e", D(2022, 3, d)) for d in days + [11]], "e string, d date")
    assert rows(timeseries.streaks(df, "e", "d")) == [
        ("e", 1, D(2022, 3, 10), D(2022, 3, 12), 3), ("e", 2, D(2022, 3, 15), D(2022, 3, 15), 1), ("e", 3, D(2022, 3, 18), D(2022, 3, 19), 2),
    ]


def test_missing_dates_and_ranges(spark, rows):
    days = {"C1": [11, 13, 17, 18], "C2": [20, 22], "C3": [9]}
    df = spark.createDataFrame([(c, D(2024, 1, d)) for c, ds in days.items() for d in ds], "c string, d date")
    assert rows(timeseries.missing_dates(df, "c", "d")) == [
        ("C1", D(2024, 1, d)) for d in (12, 14, 15, 16)
    ] + [("C2", D(2024, 1, 21))]
    assert rows(timeseries.missing_ranges(df, "c", "d")) == [
        ("C1", D(2024, 1, 12), D(2024, 1, 12)), ("C1", D(2024, 1, 14), D(2024, 1, 16)), ("C2", D(2024, 1, 21), D(2024, 1, 21)),
    ]
    assert rows(timeseries.missing_envelope(df, "c", "d"))[0] == ("C1", D(2024, 1, 12), D(2024, 1, 16))
    assert timeseries.date_spine(df, "c", "d").count() == 8 + 3 + 1


def test_intervals_and_gaps(spark, rows):
    df = spark.createDataFrame([("u", D(2024, 1, d)) for d in (1, 4, 5, 11)] + [("v", D(2024, 1, 1))], "u string, d date")
    assert rows(timeseries.avg_interval(df, "u", "d")) == [("u", 10 / 3), ("v", None)]
    assert rows(timeseries.gaps_over(df, "u", "d", 2), "d", "gap_days") == [(D(2024, 1, 4), 3), (D(2024, 1, 11), 6)]
    text = df.withColumn("d", F.col("d").cast("string"))
    assert rows(timeseries.gaps_over(text, "u", "d", 2), "gap_days") == [(3,), (6,)]


def test_rapid_events(spark, rows):
    base = TS(2024, 1, 1, 10, 0)
    df = spark.createDataFrame([("u", base + dt.timedelta(minutes=m)) for m in (0, 3, 20, 22)], "u string, ts timestamp_ntz")
    assert [r[0].minute for r in rows(timeseries.rapid_followed(df, "u", "ts", 5).where("suspicious"), "ts")] == [0, 20]
    flags = rows(timeseries.rapid_followed(df, "u", "ts", 5, "near"), "ts", "near")
    assert [f for _, f in flags] == [True, False, True, False]
    assert [r[0].minute for r in rows(timeseries.rapid_repeats(df, "u", "ts", 5), "ts")] == [3, 22]


def test_retention_and_activation(spark, rows):
    df = spark.createDataFrame([("u", D(2024, 1, d)) for d in (1, 2, 5, 8, 31)], "u string, d date")
    assert rows(timeseries.retention(df, "u", "d"), "day_n") == [(1,), (7,), (30,)]
    act = spark.createDataFrame([("u", D(2024, 1, 4)), ("w", D(2024, 1, 1))], "u string, a date")
    assert rows(timeseries.days_to_first(act, df, "u", "a", "d"), "days_to_first") == [(-3,)]
    assert rows(timeseries.days_to_first(act, df, "u", "a", "d", only_after=True), "days_to_first") == [(1,)]


def test_latest_change_and_edges(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-03", 30), (1, "2024-01-01", 10), (1, "2024-01-02", 25), (2, "2024-01-01", 7)], "c int, d string, a int")
    assert rows(timeseries.latest_change(df, "c", ["-d"], "a"), "c", "d", "change") == [
        (1, "2024-01-02", 5), (1, "2024-01-03", None), (2, "2024-01-01", None),
    ]
    assert rows(timeseries.first_and_last(df, "c", "d"), "c", "a") == [(1, 10), (1, 30), (2, 7)]


def test_busiest_buckets_of_own_bands(spark):
    df = spark.createDataFrame([(TS(2024, 12, 16, h),) for h in (3, 4, 9, 23, 12)], "ts timestamp_ntz")
    got = timeseries.busiest_buckets(df, "ts", [(12, "late"), (5, "early"), (22, "night")], 2)
    assert sorted(map(tuple, got.select("weekday", "band", "events", "rank").collect())) == [
        ("Monday", "early", 1, 2), ("Monday", "late", 1, 2), ("Monday", "night", 3, 1),
    ]


# -- missing values ---------------------------------------------------------------------------


def test_fill_and_impute(spark, rows):
    df = spark.createDataFrame([(1, "a", 10), (2, None, None), (3, "c", 15)], "id int, p string, price int")
    assert rows(nulls.fill(df, {"price": 12.5}), "price") == [(10,), (12,), (15,)]  # cut to the type
    assert rows(nulls.impute(df, "price"), "price") == [(10.0,), (12.5,), (15.0,)]
    assert rows(nulls.impute(df, ["price"], "median"), "price") == [(10.0,), (10.0,), (15.0,)]
    assert rows(nulls.drop_null(df, ["p"]), "id") == rows(df.where("p is not null"), "id") == [(1,), (3,)]
    holes = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert rows(nulls.drop_null(holes, how="all")) == [(1, None)]


def test_text_defaults(spark, rows):
    df = spark.createDataFrame([("12 Road", None), (None, None), ("a", "b")], "l1 string, l2 string")
    assert rows(nulls.join_text(df, ["l1", "l2"], "full"), "full") == [(", ",), ("12 Road, ",), ("a, b",)]
    assert rows(nulls.join_text(df, ["l1", "l2"], "full", skip_empty=True), "full") == [("",), ("12 Road",), ("a, b",)]
    assert rows(nulls.default_text(df, {"l2": "none"}), "l2") == [("b",), ("none",), ("none",)]


# -- nested data --------------------------------------------------------------------------------


def test_arrays_and_text(spark, rows):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, xs array<string>")
    assert rows(nested.explode(df, "xs", "x"), "id", "x") == [(1, "x"), (1, "y")]
    assert rows(nested.explode_pos(df, "xs", "pos", "x")) == [(1, 0, "x"), (1, 1, "y")]
    text = spark.createDataFrame([(1, "Austin, TX"), (2, "Rome")], "id int, a string")
    assert rows(nested.split_columns(text, "a", ",", ["city", "state"]), "city", "state") == [("Austin", " TX"), ("Rome", None)]
    assert rows(nested.split_columns(text, "a", ",", ["city", "state"], trim=True), "state") == [(None,), ("TX",)]
    assert rows(nested.split_rows(text, "a", ", ", "part"), "part") == [("Austin",), ("Rome",), ("TX",)]


def test_json(spark, rows):
    data = [(1, '{"device":"ios","items":["a","b"]}'), (2, "not json"), (3, '{"device":"web","items":[]}'), (4, None)]
    df = spark.createDataFrame(data, "u int, doc string")
    schema = "device string, items array<string>"
    assert rows(nested.parse_json(df, "doc", schema), "u", "device") == [(1, "ios"), (2, None), (3, "web"), (4, None)]
    assert rows(nested.parse_json(df, "doc", schema, "items", "item"), "u", "item") == [(1, "a"), (1, "b")]


# -- scalar functions ---------------------------------------------------------------------------


def test_dates(spark, rows):
    df = spark.createDataFrame(["2019-08-24", "24-08-2019", "2019.08.24", "soon"], "string").toDF("s")
    assert [r[0] for r in df.select(fn.try_parse_date("s", "yyyy-MM-dd", "MM/dd/yyyy", "Invalid Date")).collect()] == [
        "08/24/2019", "Invalid Date", "Invalid Date", "Invalid Date",
    ]
    assert [r[0] for r in df.select(fn.try_parse_date("s", "yyyy-MM-dd")).collect()] == [D(2019, 8, 24), None, None, None]
    one = spark.createDataFrame([("2024-05-03T10:00:00",)], "s string")
    assert one.select(fn.weekday_name("s", "yyyy-MM-dd'T'HH:mm:ss")).first()[0] == "Fri"
    assert one.select(fn.weekday_name("s", "yyyy-MM-dd'T'HH:mm:ss", short=False)).first()[0] == "Friday"


# -- quality and dimensions ------------------------------------------------------------------------

MELT_RULES = {"melts in range": "melt between -40 and 900", "named": "length(alloy) >= 2"}


@pytest.fixture()
def samples(spark):
    made = [("A7", 310.5), ("", 420.0), (None, 38.9), ("Zn3", None), ("q", 9000.0), ("Pb2", -40.0)]
    return spark.createDataFrame([(i, *m) for i, m in enumerate(made)], "lot int, alloy string, melt double")


def test_rules(samples, rows):
    range_, named = MELT_RULES
    assert rows(quality.expect_all_or_drop(samples, MELT_RULES), "lot") == [(0,), (5,)]
    assert rows(quality.expect_all(samples, MELT_RULES, "warn"), "lot", "failed_rules") == [
        (0, []), (1, [named]), (2, [named]), (3, [range_]), (4, [range_, named]), (5, []),
    ]
    assert rows(quality.rule_report(samples, MELT_RULES)) == [(range_, 4, 2), (named, 3, 3)]
    with pytest.raises(Exception, match="row fails: "):
        quality.expect_all(samples, MELT_RULES, "fail").collect()
    assert quality.expect_all(samples.where("lot in (0, 5)"), MELT_RULES, "fail").count() == 2


def change(key, text, action, day):
    return (key, text, action, TS(2024, 1, day))


FEED = [
    change(6, "base", "I", 1),
    change(7, "other", "I", 1),
    change(6, "new", "I", 4),
    change(6, "late", "I", 3),  # arrives after the newer one
]
SCHEMA = "k int, text string, act string, seq timestamp_ntz"


def test_scd1_sequence_delete_and_truncate(spark, rows):
    def run(*extra):
        df = spark.createDataFrame(FEED + list(extra), SCHEMA)
        return rows(cdc.scd1(df, ["k"], "seq", "act = 'D'", "act = 'T'", ["act", "seq"]))

    assert run() == [(6, "new"), (7, "other")]
    assert run(change(6, "new", "D", 5)) == [(7, "other")]
    assert run(change(6, "old delete", "D", 2)) == [(6, "new"), (7, "other")]
    assert run(change(6, "", "T", 5)) == []
    assert run(change(9, "", "T", 2)) == [(6, "new")]


def test_scd2_history(spark, rows):
    df = spark.createDataFrame(FEED, SCHEMA)
    dim = cdc.scd2(df, ["k"], "seq", ["seq", "act"])
    day = lambda d: TS(2024, 1, d)
    assert [tuple(r) for r in cdc.history(dim, "k", 6).select("text", "__START_AT", "__END_AT").collect()] == [
        ("base", day(1), day(3)), ("late", day(3), day(4)), ("new", day(4), None),
    ]
    assert rows(cdc.current(dim), "k", "text") == [(6, "new"), (7, "other")]
    deleted = spark.createDataFrame([*FEED, change(6, "gone", "D", 6)], SCHEMA)
    assert rows(cdc.scd2(deleted, ["k"], "seq", delete_when="act = 'D'").where("k = 6"), "text", "__END_AT")[-1] == ("new", day(6))
    kept = cdc.scd2(deleted, ["k"], "seq")
    assert rows(cdc.current(kept).where("k = 6"), "text") == [("gone",)]


def test_reduced_changes_give_the_same_dimension(spark, rows):
    extra = [change(6, "x", "D", 5), change(8, "", "T", 2), change(8, "y", "I", 1), change(7, "z", "I", 3), change(7, "z", "I", 3)]
    df = spark.createDataFrame(FEED + extra, SCHEMA)
    parts = [df.where(f"pmod(xxhash64(*), 3) = {i}") for i in range(3)]
    for kind in (1, 2):
        folded = None
        for p in parts:
            both = p if folded is None else folded.unionByName(p)
            folded = cdc.reduce_changes(both, ["k"], "seq", kind, "act = 'T'" if kind == 1 else None)
        if kind == 1:
            make = lambda x: cdc.scd1(x, ["k"], "seq", "act = 'D'", "act = 'T'")
        else:
            make = lambda x: cdc.scd2(x, ["k"], "seq")
        assert rows(make(folded)) == rows(make(df))


# -- sizes -------------------------------------------------------------------------------------------


def test_sizes(spark):
    df = spark.range(5000).selectExpr("id", "repeat('x', 80) as t")
    total = writers.estimate_bytes(df).first()
    assert total["rows"] == 5000 and total["mb"] == total["bytes"] / 2**20
    kept = writers.limit_to_bytes(df, 0.1)
    assert 900 < kept.count() < 1300
    assert writers.limit_to_bytes(df, 10_000).count() == 5000
    assert writers.limit_to_bytes(df.where("id < 0"), 1).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1249, 1250, 1251, 4999, 5000, 9000])
def test_prefix_rows(spark, n):
    df = spark.range(0, 5000, 1, 4)
    kept = writers.prefix_rows(df, n)
    assert [r[0] for r in kept.collect()] == list(range(min(n, 5000)))
