"""Queries over cut windows: the keys of the given tables are small, so a slice size far
below the default makes most of them hot. Their results are those of the plain queries."""

from pyspark.sql import functions as F

from tarnwork.operators import cdc, timeseries, window
from tarnwork.plans.flowing import changes_of_customers
from tarnwork.plans import ranking, temporal  # noqa: F401  (their SQL is used)
from tarnwork.plans.registry import ORACLES, query, table

#: Keys with more rows than about this are cut.
SLICED_FROM = 8


def _orders(spark, d, *more):
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", *more)


@query(ORACLES["numbered_orders"])
def numbered_orders_cut(spark, d):
    order = ["-o_totalprice", "o_orderdate", "o_orderkey"]
    numbered = window.number_rows(
        _orders(spark, d, "o_totalprice"), ["o_custkey"], order, hot_rows=SLICED_FROM
    )
    return numbered.select("o_custkey", "o_orderkey", "row_number")


@query(ORACLES["running_total_range"])
def running_total_cut(spark, d):
    r = window.running_sum(
        _orders(spark, d, "o_totalprice"),
        ["o_custkey"],
        ["o_orderdate"],
        "o_totalprice",
        "running_total",
        hot_rows=SLICED_FROM,
    )
    return r.select("o_custkey", "o_orderkey", F.round("running_total", 2).alias("running_total"))


@query(ORACLES["previous_order_date"])
def previous_cut(spark, d):
    return window.previous(
        _orders(spark, d),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        "o_orderdate",
        "previous_date",
        SLICED_FROM,
    ).drop("o_orderdate")


@query(ORACLES["sessions"])
def sessions_cut(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    return timeseries.sessionize(e, "user_id", "ts", 30, hot_rows=SLICED_FROM).select(
        "user_id", "event_id", "session_id"
    )


@query(ORACLES["scd2_customers"])
def scd2_cut(spark, d):
    feed, keys, seq, action = changes_of_customers(spark, d)
    return cdc.scd2(feed, keys, seq, [seq, action], hot_rows=SLICED_FROM)
