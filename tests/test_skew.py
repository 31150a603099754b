"""Windows over sliced hot keys have to equal the plain windows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnwork.operators import cdc, timeseries, window
from tarnwork.operators.skew import HOT, SLICE, TIE, first_rows, slice_hot_keys

START = dt.datetime(2024, 1, 1)


def make_rows(seed, order_kind, n=400):
    """Key 'h' owns most rows, some keys have one row, one key is NULL."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = rnd.choice(["h"] * 6 + ["a", "b", None, f"k{i}"])
        step = rnd.choice([rnd.randint(0, 400), 3, rnd.randint(0, 10**6)])
        pos = {
            "timestamp": START + dt.timedelta(seconds=step, microseconds=rnd.randint(0, 2)),
            "timestamp_ntz": START + dt.timedelta(seconds=step, microseconds=rnd.randint(0, 2)),
            "date": (START + dt.timedelta(days=step % 700)).date(),
            "bigint": step - 200,
            "double": rnd.choice([step / 7, -step / 3, math.inf, -math.inf, math.nan]),
            "string": f"{step % 37:03d}-{step}",
            "string collate UTF8_LCASE": f"{'aA'[i % 2]}{step % 37:03d}-{step}",
            "binary": f"Customer#{step:09d}".encode(),
        }[order_kind]
        if rnd.random() < 0.08:
            pos = None
        out.append((i, key, pos, rnd.choice([None, rnd.randint(-50, 50)])))
    return out


@pytest.fixture(scope="module", autouse=True)
def small_plans(spark):
    """Many tiny queries: planning stage by stage would take most of the time."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


KINDS = [
    "double", "timestamp_ntz", "timestamp", "date", "bigint", "string", "string collate UTF8_LCASE", "binary",
]


@pytest.fixture(scope="module")
def tables(spark):
    made = {}

    def get(kind):
        if kind not in made:
            plain = kind.split(" collate ")
            df = spark.createDataFrame(make_rows(len(kind), kind), f"id int, k string, t {plain[0]}, v int")
            if len(plain) > 1:
                df = df.withColumn("t", F.collate("t", plain[1]))
            made[kind] = df.repartition(5).cache()
        return made[kind]

    return get


def same(a, b):
    key = lambda r: tuple(str(v) for v in r)
    left, right = sorted(map(tuple, a.collect()), key=key), sorted(map(tuple, b.collect()), key=key)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        assert str(x) == str(y)


OPERATORS = {
    "number_rows": lambda df, o, h: window.number_rows(df, ["k"], [*o, "id"], "r", h),
    "rank": lambda df, o, h: window.rank(df, ["k"], o, "r", h),
    "dense_rank": lambda df, o, h: window.dense_rank(df, ["k"], o, "r", h),
    "sum_range": lambda df, o, h: window.running_sum(df, ["k"], o, "v", "r", "range", h),
    "sum_rows": lambda df, o, h: window.running_sum(df, ["k"], [*o, "id"], "v", "r", "rows", h),
    "running_min": lambda df, o, h: window.running_min(df, ["k"], o, "v", "r", h),
    "moving_avg": lambda df, o, h: window.moving_avg(df, ["k"], [*o, "id"], "v", 3, "r", h),
    "previous": lambda df, o, h: window.previous(df, ["k"], [*o, "id"], "v", "r", h),
    "rank_by_level": lambda df, o, h: window.rank(df, ["k"], o, "r", h, many_ties=h is not None),
    "dense_rank_by_level": lambda df, o, h: window.dense_rank(df, ["k"], o, "r", h, many_ties=h is not None),
    "sum_by_level": lambda df, o, h: window.running_sum(
        df, ["k"], o, "v", "r", "range", h, many_ties=h is not None
    ),
    "following": lambda df, o, h: window.following(df, ["k"], [*o, "id"], "v", "r", h),
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_sliced_equals_plain(name, kind, tables):
    op, table = OPERATORS[name], tables(kind)
    for order in ["t", "-t"] if kind == "double" else ["t" if len(name + kind) % 2 else "-t"]:
        same(op(table, [order], 7), op(table, [order], None))


def test_plain_equals_hand_written_window(tables):
    table = tables("double")
    w = Window.partitionBy("k").orderBy("t", "id")
    hand = table.withColumn("r", F.row_number().over(w).cast("long"))
    same(window.number_rows(table, ["k"], ["t", "id"], "r", 5), hand)
    hand = table.withColumn("r", F.sum("v").over(Window.partitionBy("k").orderBy("t")))
    same(window.running_sum(table, ["k"], ["t"], "v", "r", "range", 5), hand)


@pytest.mark.parametrize("hot_rows", [1, 10, 60])
def test_ties_at_the_borders_lose_no_row(hot_rows, spark):
    rnd = random.Random(hot_rows)
    rows = [("h", rnd.choice([None, 1, 2, 3, 4]), i // 2, i % 3) for i in range(240)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v int").repartition(7)
    for op in (
        lambda h: window.previous(df, ["k"], ["t"], "t", "r", h),
        lambda h: window.following(df, ["k"], ["-t"], "t", "r", h),
        lambda h: window.moving_avg(df, ["k"], ["t"], "t", 4, "r", h),
    ):
        assert sorted(map(str, op(hot_rows).select(df.columns).collect())) == sorted(
            map(str, df.collect())
        )
        # Ties fall alike in both forms.
        same(op(hot_rows), op(None))


@pytest.mark.parametrize("kind", KINDS)
def test_hot_keys_are_really_cut(kind, tables):
    cut = slice_hot_keys(tables(kind), ["k"], ["t"], 20)
    sizes = cut.where(HOT).groupBy("k", SLICE).count()
    assert cut.where(F.col("k") == "h").select(HOT).distinct().collect() == [(True,)]
    assert sizes.where("k = 'h'").count() > 3
    assert cut.where("k like 'k%'").where(HOT).count() == 0


@pytest.mark.parametrize("seed, hot_rows", [(0, 1), (1, 3), (2, 25), (3, 10**6), (4, 2)])
def test_sessions_and_streaks(seed, hot_rows, spark):
    rnd = random.Random(seed)
    moment = START
    rows = []
    for i in range(150):
        moment += dt.timedelta(minutes=rnd.choice([0, 1, 5, 29, 30, 31, 600]))
        rows.append((i, rnd.choice(["h", "h", "h", "x"]), None if rnd.random() < 0.05 else moment))
    df = spark.createDataFrame(rows, "id int, u string, ts timestamp_ntz")
    same(
        timeseries.sessionize(df, "u", "ts", 30, hot_rows=hot_rows),
        timeseries.sessionize(df, "u", "ts", 30, hot_rows=None),
    )
    # A repeated day breaks a streak here, as it does row by row.
    days = df.where("ts is not null").select("u", F.col("ts").cast("date").alias("d"))
    same(
        timeseries.streaks(days, "u", "d", dedupe=False, hot_rows=hot_rows),
        timeseries.streaks(days, "u", "d", dedupe=False, hot_rows=None),
    )


def test_hot_dimension_key(spark):
    rows = [(7, f"v{i}", START + dt.timedelta(hours=i * i)) for i in range(40)] + [(8, "x", START)]
    df = spark.createDataFrame(rows, "k int, v string, seq timestamp_ntz").repartition(6)
    same(
        cdc.scd2(df, ["k"], "seq", hot_rows=3),
        cdc.scd2(df, ["k"], "seq", hot_rows=None),
    )


def test_two_keys_and_single_position(spark):
    rows = [(1, 2, 5, i) for i in range(30)] + [(1, 3, i, i) for i in range(30)]
    df = spark.createDataFrame(rows, "a int, b int, t int, v int")
    same(
        window.running_sum(df, ["a", "b"], ["t"], "v", "r", "range", 4),
        window.running_sum(df, ["a", "b"], ["t"], "v", "r", "range", None),
    )


def test_hot_keys_found_in_a_sample(spark):
    df = spark.range(60_000).selectExpr(
        "id", "case when id % 3 = 0 then 1 else id end as k", "id * 7 % 1000 as t"
    )
    cut = slice_hot_keys(df, ["k"], ["t", "id"], 100_000)
    assert cut.count() == 60_000
    assert cut.where(HOT).count() == 0
    cut = slice_hot_keys(df, ["k"], ["t", "id"], 19_000)
    assert cut.where(HOT).select("k").distinct().collect() == [(1,)]
    assert cut.where(HOT).groupBy(SLICE).count().agg(F.max("count")).first()[0] < 5_000
    same(
        window.number_rows(df, ["k"], ["t", "id"], "r", 19_000),
        window.number_rows(df, ["k"], ["t", "id"], "r", None),
    )


@pytest.mark.parametrize("order", [["d", "id"], ["-d", "id"], ["d", "-id"], ["-d", "-v", "id"]])
def test_few_values_and_mixed_directions(order, spark):
    rnd = random.Random(5)
    rows = [("h", rnd.choice([1, 1, 1, 2, None]), i, rnd.choice([None, 1, 2, 3])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, d int, id int, v int").repartition(4)
    biggest = slice_hot_keys(df, ["k"], order, 20).groupBy(SLICE).count().agg(F.max("count"))
    assert biggest.first()[0] <= 6
    for name in ("number_rows", "moving_avg") if order[0] == "d" else ("previous", "rank"):
        op = {
            "number_rows": lambda h: window.number_rows(df, ["k"], order, "r", h),
            "moving_avg": lambda h: window.moving_avg(df, ["k"], order, "v", 2, "r", h),
            "previous": lambda h: window.previous(df, ["k"], order, "id", "r", h),
            "rank": lambda h: window.rank(df, ["k"], order, "r", h),
        }[name]
        same(op(20), op(None))


SHAPES = {
    "outlier": "if(id = 0, timestamp'0001-01-01', timestamp'2024-01-01' + make_dt_interval(0, 0, 0, v))",
    "common_prefix": "format_string('Customer#%09d', v)",
    "binary": "encode(format_string('Customer#%09d', v), 'utf-8')",
    "collated": "collate(concat(if(id % 2 = 0, 'a', 'A'), v), 'UTF8_LCASE')",
    "tied": "v % 3",
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_slices_are_of_equal_depth(shape, spark):
    df = spark.range(50_000).selectExpr("id", "'h' as k", "id * 7919 % 50021 as v")
    df = df.withColumn("t", F.expr(SHAPES[shape]))
    sizes = slice_hot_keys(df, ["k"], ["-t"], 1000).groupBy(SLICE).count()
    slices, largest = sizes.agg(F.count(F.lit(1)), F.max("count")).first()
    assert largest <= 2 * 50_000 / slices and slices > 100
    same(
        window.number_rows(df, ["k"], ["-t"], "r", 1000).agg(F.sum(F.expr("r * (id % 1009)"))),
        window.number_rows(df, ["k"], ["-t"], "r", None).agg(F.sum(F.expr("r * (id % 1009)"))),
    )


def test_repeated_rows_do_not_swell_the_sample(spark):
    """Rows equal in all columns stay together, whatever the sample holds."""
    df = spark.range(3_000).selectExpr("'h' as k", "cast(id % 2 as int) as t", "1 as v")
    for peers in (False, True):
        assert slice_hot_keys(df, ["k"], ["t"], 100, peers).count() == 3_000
    same(
        window.running_sum(df, ["k"], ["t"], "v", "r", "rows", 100),
        window.running_sum(df, ["k"], ["t"], "v", "r", "rows", None),
    )


def test_one_value_of_a_hot_key_is_hot_itself(spark):
    """Nine tenths of the rows tie: ranks and sums come per distinct value, of which no
    slice holds more than twice the mean."""
    df = spark.range(20_000).selectExpr(
        "'h' as k", "case when id % 10 > 0 then 5 else id % 1000 end as t", "cast(id % 7 as int) as v", "id"
    )
    assert window._peers(df, ["k"], ["t"], 1000, None) == (1000, True)
    assert window._peers(df, ["k"], ["id"], 1000, None) == (1000, False)
    assert window._peers(df, ["k"], ["t"], 100_000, None) == (None, False)
    for op in (window.rank, window.dense_rank):
        same(op(df, ["k"], ["-t"], "r", 1000), op(df, ["k"], ["-t"], "r", None))
    same(
        window.running_sum(df, ["k"], ["t"], "v", "r", "range", 1000),
        window.running_sum(df, ["k"], ["t"], "v", "r", "range", None),
    )
    same(
        window.running_min(df, ["k"], ["-t"], "v", "r", 1000),
        window.running_min(df, ["k"], ["-t"], "v", "r", None),
    )
    levels = slice_hot_keys(df.select("k", "t").distinct(), ["k"], ["t"], 200)
    slices, largest, all_ = levels.groupBy(SLICE).count().agg(F.count(F.lit(1)), F.max("count"), F.sum("count")).first()
    assert largest <= 2 * all_ / slices


@pytest.mark.parametrize("order", [["t"], ["-t"], ["t", "-v"]])
def test_first_rows_by_one_rule_for_any_n(order, spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("hhhhhhx"), rnd.choice([None, *range(9)]), rnd.randrange(4), i) for i in range(2500)]
    df = spark.createDataFrame(rows, "k string, t int, v int, id int").repartition(5)
    for n in (3, window.GROUP_LIMIT, window.GROUP_LIMIT + 1, 1100):
        cut = window.top_n(df, ["k"], order, n, "r", hot_rows=400)
        same(cut, window.top_n(df, ["k"], order, n, "r", hot_rows=None))
    short, long = (
        {r["id"] for r in window.top_n(df, ["k"], order, n, hot_rows=400).collect()}
        for n in (window.GROUP_LIMIT, window.GROUP_LIMIT + 1)
    )
    assert short < long and len(long - short) == 2


def test_few_rows_behind_the_bound_are_sorted(spark):
    df = spark.range(60_000).selectExpr("'h' as k", "id * 7919 % 60013 as t", "id").withColumn(
        TIE, F.xxhash64("k", "t", "id")
    )
    kept = first_rows(df, ["k"], ["t", TIE], 500, 10_000)
    assert 500 <= kept.count() < 3 * 500
    assert {r["t"] for r in kept.orderBy("t").limit(500).collect()} == {r["t"] for r in df.orderBy("t").limit(500).collect()}


def test_null_sequences_and_equal_sequences_of_a_dimension(spark):
    rows = [(1, "a", None), (1, "b", None), (1, "c", 3), (1, "d", 3), (1, "e", 4), (None, "f", None), (2, "g", 1)]
    df = spark.createDataFrame(rows, "k int, v string, seq int").repartition(3)
    for hot_rows in (1, None):
        out = cdc.scd2(df, ["k"], "seq", hot_rows=hot_rows).collect()
        spans = sorted((str(r["k"]), str(r["seq"]), str(r["__END_AT"])) for r in out)
        assert spans == [("1", "3", "4"), ("1", "4", "None"), ("1", "None", "3"), ("2", "1", "None"), ("None", "None", "None")]
    same(cdc.scd2(df, ["k"], "seq"), cdc.scd2(cdc.reduce_changes(df, ["k"], "seq", 2), ["k"], "seq"))


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t int, v int")
    assert window.number_rows(df, ["k"], ["t"], "r", 5).count() == 0
    assert window.previous(df, ["k"], ["t"], "v", "r", 5).count() == 0
