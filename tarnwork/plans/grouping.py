"""Aggregates, pivots, statistics, arrays and missing values."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.operators import aggregate as agg
from tarnwork.operators import joins, nested, nulls, project, window
from tarnwork.plans.registry import query, table

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _r(name: str, digits: int):
    return F.round(name, digits).alias(name)


@query(
    """SELECT o_orderstatus, count(nullif(o_orderpriority, '5-LOW')) AS with_priority,
         count(*) AS all_rows, count(1) AS literal_rows FROM orders GROUP BY 1"""
)
def counts_per_status(spark, d):
    o = table(spark, d, "orders")
    return agg.group(
        o,
        ["o_orderstatus"],
        {
            "with_priority": F.count(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))),
            "all_rows": F.count("*"),
            "literal_rows": F.count(F.lit(1)),
        },
    )


@query(
    """SELECT c_mktsegment, count(*) AS row_count,
         round(sum(o_totalprice), 2) AS sum_o_totalprice, round(avg(o_totalprice), 4) AS avg_o_totalprice,
         min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def segment_profile(spark, d):
    o = joins.join(
        table(spark, d, "orders"), table(spark, d, "customer"), {"o_custkey": "c_custkey"}
    )
    p = agg.group_profile(o, ["c_mktsegment"], ["o_totalprice"])
    return p.withColumns(
        {
            "sum_o_totalprice": F.round("sum_o_totalprice", 2),
            "avg_o_totalprice": F.round("avg_o_totalprice", 4),
        }
    )


@query(
    """SELECT o_orderpriority, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
         min(o_orderstatus) AS min_status, max(o_orderstatus) AS max_status,
         min(o_totalprice) AS min_price, max(o_totalprice) AS max_price FROM orders GROUP BY 1"""
)
def min_max_per_priority(spark, d):
    return agg.group(
        table(spark, d, "orders"),
        ["o_orderpriority"],
        {
            "first_date": F.min("o_orderdate"),
            "last_date": F.max("o_orderdate"),
            "min_status": F.min("o_orderstatus"),
            "max_status": F.max("o_orderstatus"),
            "min_price": F.min("o_totalprice"),
            "max_price": F.max("o_totalprice"),
        },
    )


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS distinct_parts FROM lineitem GROUP BY 1")
def distinct_parts_per_supplier(spark, d):
    return agg.group(
        table(spark, d, "lineitem"), ["l_suppkey"], {"distinct_parts": F.count_distinct("l_partkey")}
    )


@query(
    """SELECT o_custkey, count(DISTINCT o_orderstatus) AS statuses, round(avg(o_totalprice), 6) AS avg_price
       FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1 AND avg(o_totalprice) > 250000"""
)
def having_distinct_and_average(spark, d):
    return agg.group(
        table(spark, d, "orders"),
        ["o_custkey"],
        {"statuses": F.count_distinct("o_orderstatus"), "avg_price": F.avg("o_totalprice")},
        having=(F.col("statuses") > 1) & (F.col("avg_price") > 250000),
    ).select("o_custkey", "statuses", _r("avg_price", 6))


@query(
    """SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
       FROM lineitem GROUP BY 1 HAVING sum(l_extendedprice * (1 - l_discount)) > 1500000"""
)
def revenue_over_threshold(spark, d):
    l = project.with_columns(
        table(spark, d, "lineitem"),
        {"amount": F.col("l_extendedprice") * (1 - F.col("l_discount"))},
    )
    return agg.group(
        l, ["l_partkey"], {"revenue": F.sum("amount")}, having="revenue > 1500000"
    ).select("l_partkey", _r("revenue", 4))


@query(
    """SELECT o_custkey, round(sum(o_totalprice), 2) AS total_amount, max(o_orderdate) AS last_date
       FROM orders GROUP BY 1 ORDER BY total_amount DESC, o_custkey LIMIT 10"""
)
def top_customers_by_total(spark, d):
    return agg.top_groups(
        table(spark, d, "orders"),
        ["o_custkey"],
        {"total_amount": F.round(F.sum("o_totalprice"), 2), "last_date": F.max("o_orderdate")},
        ["-total_amount", "o_custkey"],
        10,
    )


@query(
    """WITH t AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS total_amount FROM orders
                  GROUP BY 1 ORDER BY total_amount DESC, o_custkey LIMIT 10),
            l AS (SELECT o_custkey, o_orderkey, o_orderdate FROM orders
                  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
       SELECT o_custkey, total_amount, o_orderkey, o_orderdate FROM t JOIN l USING (o_custkey)"""
)
def top_customers_with_latest_order(spark, d):
    o = table(spark, d, "orders")
    top = agg.top_groups(
        o,
        ["o_custkey"],
        {"total_amount": F.round(F.sum("o_totalprice"), 2)},
        ["-total_amount", "o_custkey"],
        10,
    )
    last = window.latest(
        o.select("o_custkey", "o_orderkey", "o_orderdate"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
    )
    return joins.join(top, last, "o_custkey")


@query(
    """SELECT count(*) AS orders, round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS highest,
         min(o_orderdate) AS first_date FROM orders"""
)
def order_totals(spark, d):
    return agg.scalar_agg(
        table(spark, d, "orders"),
        {
            "orders": F.count(F.lit(1)),
            "total": F.round(F.sum("o_totalprice"), 2),
            "highest": F.max("o_totalprice"),
            "first_date": F.min("o_orderdate"),
        },
    )


@query(
    """SELECT c_custkey, round(c_acctbal - (SELECT avg(c_acctbal) FROM customer), 4) AS above_mean
       FROM customer"""
)
def balance_above_mean(spark, d):
    c = agg.with_scalars(table(spark, d, "customer"), {"mean": F.avg("c_acctbal")})
    return c.select("c_custkey", F.round(F.col("c_acctbal") - F.col("mean"), 4).alias("above_mean"))


@query(
    """SELECT o_custkey, (date_diff('day', min(o_orderdate), max(o_orderdate)) + 1)::INT AS span_days
       FROM orders GROUP BY 1"""
)
def active_days_span(spark, d):
    return agg.group(
        table(spark, d, "orders"),
        ["o_custkey"],
        {"span_days": F.date_diff(F.max("o_orderdate"), F.min("o_orderdate")) + 1},
    )


@query(
    """SELECT o_orderkey, o_orderpriority, o_totalprice,
         round(avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS avg_price,
         count(*) OVER (PARTITION BY o_orderpriority) AS order_count
       FROM orders WHERE o_orderdate > DATE '2000-01-01' AND o_orderpriority = '2-HIGH'"""
)
def group_stats_beside_rows(spark, d):
    o = project.where(
        table(spark, d, "orders"),
        (F.col("o_orderdate") > F.lit("2000-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderpriority") == F.lit("2-HIGH")),
    )
    s = agg.with_group_stats(
        o, ["o_orderpriority"], {"avg_price": F.avg("o_totalprice"), "order_count": F.count(F.lit(1))}
    )
    return s.select("o_orderkey", "o_orderpriority", "o_totalprice", _r("avg_price", 4), "order_count")


# -- pivots --------------------------------------------------------------------


def _orders_with_segment(spark, d):
    o = table(spark, d, "orders")
    return joins.join(o, table(spark, d, "customer"), {"o_custkey": "c_custkey"})


@query(
    """SELECT c_mktsegment, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS F,
         round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS O,
         round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS P
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def pivot_status_by_segment(spark, d):
    o = _orders_with_segment(spark, d)
    p = agg.pivot(o, ["c_mktsegment"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    return p.select("c_mktsegment", *[_r(s, 2) for s in "FOP"])


@query(
    """SELECT o_orderpriority, """
    + ", ".join(f"max(o_totalprice) FILTER (c_mktsegment = '{s}') AS {s}" for s in _SEGMENTS)
    + """ FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def pivot_max_by_priority(spark, d):
    o = _orders_with_segment(spark, d)
    return agg.pivot(o, ["o_orderpriority"], "c_mktsegment", _SEGMENTS, "o_totalprice", "max")


@query(
    """WITH p AS (SELECT o_orderpriority, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS F,
         sum(o_totalprice) FILTER (o_orderstatus = 'O') AS O,
         sum(o_totalprice) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1)
       SELECT o_orderpriority, round(F + O + P, 2) AS total, round(F / (F + O + P) * 100, 2) AS F_share,
         round(O / (F + O + P) * 100, 2) AS O_share, round(P / (F + O + P) * 100, 2) AS P_share FROM p"""
)
def pivot_share_by_priority(spark, d):
    p = agg.pivot(
        table(spark, d, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], "o_totalprice"
    )
    s = agg.pivot_share(p, ["F", "O", "P"], digits=2)
    return s.select("o_orderpriority", _r("total", 2), "F_share", "O_share", "P_share")


@query(
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem"""
)
def unpivot_line_measures(spark, d):
    return agg.unpivot(
        table(spark, d, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_quantity", "l_discount", "l_tax"],
        "measure",
        "amount",
    )


# -- statistics ------------------------------------------------------------------


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem")
def corr_quantity_price(spark, d):
    c = agg.correlation(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return c.select(_r("correlation", 6))


@query(
    """SELECT quantile_disc(l_quantity, 0.5)::DOUBLE AS l_quantity,
         quantile_disc(l_extendedprice, 0.5)::DOUBLE AS l_extendedprice,
         quantile_disc(l_partkey, 0.5)::DOUBLE AS l_partkey FROM lineitem"""
)
def median_line_measures(spark, d):
    return agg.median(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_partkey"])


_GAPPY_PART = """SELECT p_partkey, p_size, CASE WHEN p_type <> 'ECONOMY' THEN p_retailprice END AS price,
                   CASE WHEN p_name <> 'red widget' THEN p_name END AS p_name FROM part"""


def _gappy_part(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        "p_size",
        F.when(F.col("p_type") != "ECONOMY", F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_name") != "red widget", F.col("p_name")).alias("p_name"),
    )


@query(
    f"""WITH g AS ({_GAPPY_PART})
        SELECT p_partkey, round(coalesce(price, (SELECT avg(price) FROM g)), 4) AS price
        FROM g WHERE p_name IS NOT NULL"""
)
def impute_mean_price(spark, d):
    # The mean is that of all rows; rows without a name go afterwards.
    p = nulls.impute(_gappy_part(spark, d), "price", "mean")
    return nulls.drop_null(p, ["p_name"]).select("p_partkey", _r("price", 4))


@query(
    f"""WITH g AS (SELECT p_partkey, price, CASE WHEN p_size <> 20 THEN p_size END AS p_size FROM ({_GAPPY_PART}))
        SELECT p_partkey::DOUBLE AS p_partkey, coalesce(price, (SELECT quantile_disc(price, 0.5) FROM g)) AS price,
          coalesce(p_size, (SELECT quantile_disc(p_size, 0.5) FROM g))::DOUBLE AS p_size FROM g"""
)
def impute_median_of_numbers(spark, d):
    p = _gappy_part(spark, d).select(
        "p_partkey", "price", F.when(F.col("p_size") != 20, F.col("p_size")).alias("p_size")
    )
    return nulls.impute(p, project.columns_of_type(p, T.NumericType), "median")


@query(
    f"""SELECT p_partkey, coalesce(price, 0.0) AS price, coalesce(p_name, 'none') AS p_name, p_size
        FROM ({_GAPPY_PART})"""
)
def fill_constants(spark, d):
    return nulls.fill(_gappy_part(spark, d), {"price": 0.0, "p_name": "none"})


@query(
    f"""SELECT p_partkey, price, p_name FROM ({_GAPPY_PART}) WHERE price IS NOT NULL OR p_name IS NOT NULL"""
)
def drop_all_null(spark, d):
    p = _gappy_part(spark, d).select("p_partkey", "price", "p_name")
    return nulls.drop_null(p, ["price", "p_name"], how="all")


_SHORT_PARTS = """SELECT p_partkey, nullif(p_brand, 'Brand#11') AS brand,
                    CASE WHEN p_size > 10 THEN p_type END AS kind, p_name FROM part"""


@query(
    f"""SELECT p_partkey, brand, coalesce(kind, 'SMALL GOODS') AS kind,
          coalesce(brand, '') || '/' || coalesce(kind, '') || '/' || coalesce(p_name, '') AS shelf_mark,
          concat_ws('/', brand, kind, p_name) AS spoken_mark FROM ({_SHORT_PARTS})"""
)
def null_defaults_and_joined_text(spark, d):
    """Shelf marks of parts: with a place for every field, and as they are read out."""
    parts = table(spark, d, "part").select(
        "p_partkey",
        F.nullif(F.col("p_brand"), F.lit("Brand#11")).alias("brand"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("kind"),
        "p_name",
    )
    fields = ["brand", "kind", "p_name"]
    marked = nulls.join_text(parts, fields, "shelf_mark", "/")
    marked = nulls.join_text(marked, fields, "spoken_mark", "/", skip_empty=True)
    return nulls.default_text(marked, {"kind": "SMALL GOODS"}).drop("p_name")


# -- arrays, text and JSON --------------------------------------------------------


@query(
    """SELECT o_custkey, string_agg(month, ',' ORDER BY month) AS months
       FROM (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders) GROUP BY 1"""
)
def implode_order_months(spark, d):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    # Distinct months: a customer's array cannot outgrow the calendar.
    o = agg.distinct(table(spark, d, "orders").select("o_custkey", month))
    a = agg.implode(o, ["o_custkey"], "month", ["month"], "months")
    return a.withColumn("months", F.array_join("months", ","))


@query(
    """WITH n AS (SELECT user_id, event_type, ts, event_id,
         ((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 20)::BIGINT AS part FROM events)
       SELECT user_id, part, string_agg(event_type, '>' ORDER BY ts, event_id) AS path FROM n GROUP BY 1, 2"""
)
def implode_events_in_chunks(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
    a = agg.implode(e, ["user_id"], "event_type", ["ts", "event_id"], "path", chunk=20)
    return a.withColumn("path", F.array_join("path", ">"))


@query("SELECT p_partkey, string_agg(w, ' ' ORDER BY w) AS words FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1")
def array_round_trip(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    exploded = project.drop(nested.explode(p, "words", "word"), ["words"])
    back = agg.implode(exploded, ["p_partkey"], "word", ["word"], "words")
    return back.withColumn("words", F.array_join("words", " "))


@query(
    """SELECT l_returnflag, round(sum(l_extendedprice) + sum(l_extendedprice * l_tax), 2) AS total
       FROM lineitem GROUP BY 1"""
)
def nested_sum(spark, d):
    l = table(spark, d, "lineitem").select(
        "l_returnflag",
        F.array(
            F.create_map(F.lit("amount"), F.col("l_extendedprice")),
            F.create_map(F.lit("amount"), F.col("l_extendedprice") * F.col("l_tax")),
        ).alias("charges"),
    )
    return agg.sum_nested(l, ["l_returnflag"], "charges", "amount").select(
        "l_returnflag", _r("total", 2)
    )


@query(
    """SELECT word, count(*) AS word_count
       FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1"""
)
def word_count(spark, d):
    return agg.word_count(table(spark, d, "documents"), "text")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def split_names_to_rows(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return nested.split_rows(p, "p_name", " ", "word").drop("p_name")


@query(
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2) AS second_word,
         CAST(NULL AS VARCHAR) AS third_word FROM part"""
)
def split_names_to_columns(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return nested.split_columns(p, "p_name", " ", ["first_word", "second_word", "third_word"]).drop("p_name")


@query(
    """SELECT p_partkey, (i - 1)::INT AS pos, string_split(p_name, ' ')[i] AS word
       FROM part, (SELECT unnest([1, 2, 3, 4]) AS i) WHERE i <= len(string_split(p_name, ' '))"""
)
def explode_with_position(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return nested.explode_pos(p, "words", "pos", "word")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def parse_json_props(spark, d):
    e = table(spark, d, "events").select("event_id", "props")
    return nested.parse_json(e, "props", "k bigint")


@query(
    """WITH e AS (SELECT event_id, event_type, unnest([event_type, CAST(user_id AS VARCHAR)]) AS item FROM events)
       SELECT event_id, event_type AS kind, item FROM e"""
)
def parse_json_with_items(spark, d):
    e = table(spark, d, "events").select(
        "event_id",
        F.to_json(
            F.struct(
                F.col("event_type").alias("kind"),
                F.array("event_type", F.col("user_id").cast("string")).alias("items"),
            )
        ).alias("doc"),
    )
    return nested.parse_json(e, "doc", "kind string, items array<string>", "items", "item").drop("items")
