"""Joins, projections, filters, labels and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.functions import scalars as fn
from tarnwork.operators import aggregate as agg
from tarnwork.operators import joins, project, window
from tarnwork.plans.registry import query, table


def _orders_by_customer(spark, d):
    o = table(spark, d, "orders")
    return project.rename(o, {"o_custkey": "c_custkey"})


@query(
    """SELECT c_custkey, c_mktsegment, count(o_orderkey) AS order_count,
         round(sum(o_totalprice), 2) AS total_price, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest_order
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2"""
)
def customer_order_profile(spark, d):
    # One aggregate, combined before its shuffle; the latest order is the largest pair.
    last = F.max(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"]
    profile = agg.group(
        table(spark, d, "orders"),
        ["o_custkey"],
        {"order_count": F.count("o_orderkey"), "total_price": F.sum("o_totalprice"), "latest_order": last},
    )
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return joins.join(c, profile, {"c_custkey": "o_custkey"}, "left").select(
        "c_custkey",
        "c_mktsegment",
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.round("total_price", 2).alias("total_price"),
        "latest_order",
    )


@query("SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey")
def inner_join_shared_name(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = _orders_by_customer(spark, d).select("c_custkey", "o_orderkey", "o_totalprice")
    return joins.join(c, o, "c_custkey")


@query("SELECT c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def inner_join_two_names(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return project.select(joins.join(c, n, {"c_nationkey": "n_nationkey"}), ["c_name", "n_name"])


@query(
    """SELECT c_custkey, o_orderkey FROM customer
       LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 450000) ON c_custkey = o_custkey"""
)
def left_join_large_orders(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    o = table(spark, d, "orders").where("o_totalprice > 450000").select("o_custkey", "o_orderkey")
    return joins.join(c, o, {"c_custkey": "o_custkey"}, "left").select("c_custkey", "o_orderkey")


_WITHOUT_LARGE = """SELECT c_custkey, c_name FROM customer
   WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)"""


@query(_WITHOUT_LARGE)
def unmatched_by_anti_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = table(spark, d, "orders").where("o_totalprice > 450000")
    return joins.unmatched(c, o, {"c_custkey": "o_custkey"})


@query(_WITHOUT_LARGE)
def unmatched_by_outer_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = table(spark, d, "orders").where("o_totalprice > 450000")
    return joins.unmatched(c, o, {"c_custkey": "o_custkey"}, via="outer")


@query(
    """SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events e WHERE event_type = 'view'
       AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id
                       AND CAST(p.ts AS DATE) = CAST(e.ts AS DATE))"""
)
def view_days_without_purchase(spark, d):
    e = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    views = agg.distinct(e.where("event_type = 'view'"), ["user_id", "day"])
    bought = agg.distinct(e.where("event_type = 'purchase'"), ["user_id", "day"])
    return joins.unmatched(views, bought, {"user_id": "user_id", "day": "day"})


_FULL = """SELECT o_custkey, a.o_orderkey AS first_key, b.o_orderkey AS second_key
   FROM (SELECT o_custkey, o_orderkey FROM orders WHERE o_totalprice > 470000) a
   FULL JOIN (SELECT o_custkey, o_orderkey FROM orders WHERE o_totalprice < 30000) b USING (o_custkey)"""


def _full_sides(spark, d):
    o = table(spark, d, "orders")
    a = o.where("o_totalprice > 470000").select("o_custkey", F.col("o_orderkey").alias("first_key"))
    b = o.where("o_totalprice < 30000").select("o_custkey", F.col("o_orderkey").alias("second_key"))
    return a, b


@query(_FULL)
def full_join(spark, d):
    return joins.full_join(*_full_sides(spark, d), "o_custkey")


@query(
    """WITH a AS (SELECT o_custkey AS custkey, round(sum(o_totalprice), 2) AS spent, max(o_orderpriority) AS priority
                  FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1),
            b AS (SELECT o_custkey AS custkey, round(sum(o_totalprice), 2) AS spent, max(o_orderpriority) AS priority
                  FROM orders WHERE year(o_orderdate) = 1999 GROUP BY 1)
       SELECT coalesce(a.custkey, 0) AS y1_custkey, coalesce(a.spent, 0) AS y1_spent,
              coalesce(a.priority, 'not applicable') AS y1_priority,
              coalesce(b.custkey, 0) AS y2_custkey, coalesce(b.spent, 0) AS y2_spent,
              coalesce(b.priority, 'not applicable') AS y2_priority
       FROM a FULL JOIN b ON a.custkey = b.custkey"""
)
def reconcile_two_years(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "custkey")

    def year(n):
        return agg.group(
            o.where(F.year("o_orderdate") == n),
            ["custkey"],
            {"spent": F.round(F.sum("o_totalprice"), 2), "priority": F.max("o_orderpriority")},
        )

    defaults = {"custkey": 0, "spent": 0.0, "priority": "not applicable"}
    return joins.reconcile(
        year(1996),
        year(1999),
        "custkey",
        "y1_",
        "y2_",
        {p + c: v for p in ("y1_", "y2_") for c, v in defaults.items()},
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, s_name, l_quantity
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
)
def broadcast_join_supplier(spark, d):
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return joins.join(l, s, "l_suppkey", broadcast=True)


@query("SELECT c_custkey, r_regionkey, r_name FROM customer CROSS JOIN region")
def every_customer_with_every_region(spark, d):
    return joins.cross(table(spark, d, "customer").select("c_custkey"), table(spark, d, "region"))


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey"""
)
def salted_join_customer(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, d, "customer").where("c_acctbal > 0")
    c = c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.salted_join(o, c, "o_custkey", 4)


def _salted(spark, d, how):
    """All orders with the customers who owe nothing and those without orders."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").where("c_acctbal > 0")
    return joins.salted_join(o, c.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", 4, how)


_SALTED = """SELECT o_orderkey, o_custkey, c_name
    FROM (SELECT o_orderkey, o_custkey FROM orders)
    {} JOIN (SELECT c_custkey AS o_custkey, c_name FROM customer WHERE c_acctbal > 0) USING (o_custkey)"""


@query(_SALTED.format("RIGHT"))
def salted_join_right(spark, d):
    return _salted(spark, d, "right")


@query(_SALTED.format("FULL"))
def salted_join_full(spark, d):
    return _salted(spark, d, "full")


@query(
    """WITH n AS (SELECT c_custkey, c_name, CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS parent FROM customer)
       SELECT a.c_custkey, a.c_name, a.parent, b.c_name AS parent_name
       FROM n a LEFT JOIN n b ON a.parent = b.c_custkey"""
)
def resolve_parent_customer(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 10)).alias("parent"),
    )
    return joins.resolve_parent(c, "c_custkey", "parent", "c_name")


@query(
    """WITH b AS (SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1)
       SELECT o.o_custkey, o.o_orderkey, o.o_orderdate FROM orders o JOIN b
       ON o.o_custkey = b.o_custkey AND (o.o_orderdate = b.lo OR o.o_orderdate = b.hi)"""
)
def first_or_last_by_theta_join(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    b = agg.group(o, ["o_custkey"], {"lo": F.min("o_orderdate"), "hi": F.max("o_orderdate")})
    b = project.rename(b, {"o_custkey": "custkey"})
    pred = (o["o_custkey"] == b["custkey"]) & (
        (o["o_orderdate"] == b["lo"]) | (o["o_orderdate"] == b["hi"])
    )
    return joins.join(o, b, pred).select("o_custkey", "o_orderkey", "o_orderdate")


# -- projections and filters --------------------------------------------------------


@query(
    """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'in debt' WHEN s_acctbal < 1000 THEN 'little credit'
         WHEN s_acctbal < 8000 THEN 'usual' ELSE 'rich' END AS standing FROM supplier"""
)
def label_price_band(spark, d):
    """Account standing of suppliers, by the first bound that holds."""
    bounds = [(0, "in debt"), (1000, "little credit"), (8000, "usual")]
    branches = [(F.col("s_acctbal") < bound, name) for bound, name in bounds]
    return project.label(table(spark, d, "supplier"), "standing", branches, "rich").select("s_suppkey", "standing")


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN 'returned at full price'
         WHEN l_returnflag = 'R' THEN 'returned' WHEN l_quantity > 45 THEN 'bulk' ELSE 'plain' END AS handling
       FROM lineitem"""
)
def label_mixed_rules(spark, d):
    """Handling of order lines, from columns of several kinds."""
    rules = [
        ("l_returnflag = 'R' AND l_discount = 0", "returned at full price"),
        ("l_returnflag = 'R'", "returned"),
        ("l_quantity > 45", "bulk"),
    ]
    lines = project.label(table(spark, d, "lineitem"), "handling", rules, "plain")
    return lines.select("l_orderkey", "l_linenumber", "handling")


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 100000 AND 200000
         AND nullif(o_orderpriority, '2-HIGH') IS NOT NULL AND o_orderstatus <> 'P'
         OR (o_totalprice > 499000 AND nullif(o_orderpriority, '2-HIGH') IS NULL)"""
)
def filters_mixed(spark, d):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("2-HIGH"))
    price = F.col("o_totalprice")
    pred = (
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & price.between(100000, 200000)
        & priority.isNotNull()
        & (F.col("o_orderstatus") != "P")
    ) | ((price > 499000) & priority.isNull())
    return project.where(table(spark, d, "orders"), pred).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )


_BALANCE_AS_TEXT = """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'not told'
      WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE ' ' || round(c_acctbal)::BIGINT END AS balance FROM customer"""


@query(
    f"""SELECT c_custkey, balance, TRY_CAST(balance AS DOUBLE) <= 0 AS owes FROM ({_BALANCE_AS_TEXT})
        WHERE TRY_CAST(balance AS DOUBLE) > 5000 OR TRY_CAST(balance AS DOUBLE) <= 0"""
)
def text_against_number(spark, d):
    """Balances kept as text, some of them no numbers, compared with numbers."""
    balance = F.when(F.col("c_mktsegment") == "BUILDING", "not told").when(
        F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit(" "), F.round("c_acctbal").cast("long"))
    )
    c = table(spark, d, "customer").select("c_custkey", balance.alias("balance"))
    rich = project.where_number(c, "balance", ">", 5000).withColumn("owes", F.lit(False))
    owing = project.where_number(c, "balance", "<=", 0).withColumn("owes", F.lit(True))
    return rich.unionByName(owing)


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000")
def filter_by_text(spark, d):
    o = project.where(table(spark, d, "orders"), "o_orderstatus == 'F' AND o_totalprice > 300000")
    return o.select("o_orderkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE upper(c_mktsegment) = 'BUILDING'")
def filter_any_case(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return project.where_ci(c, "c_mktsegment", "Building")


@query("SELECT c_custkey AS custKey, c_name AS customerName, c_acctbal FROM customer")
def rename_and_reorder(spark, d):
    c = table(spark, d, "customer").select("c_name", "c_acctbal", "c_custkey")
    c = project.rename(c, {"c_custkey": "custKey", "c_name": "customerName"})
    return project.reorder(c, ["custKey", "customerName", "c_acctbal"])


@query("SELECT c_custkey AS cust_key, c_name AS customer_name, c_acctbal AS acct_bal FROM customer")
def snake_case_names(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("custKey"),
        F.col("c_name").alias("customerName"),
        F.col("c_acctbal").alias("acctBal"),
    )
    return project.snake_case_columns(c)


@query("SELECT s_suppkey AS df1_s_suppkey, s_name AS df1_s_name FROM supplier")
def prefixed_names(spark, d):
    return project.prefix_columns(table(spark, d, "supplier").select("s_suppkey", "s_name"), "df1_")


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice - l_quantity AS difference,
         l_quantity * 2 AS doubled, 'line' AS kind, upper(l_returnflag) || '-' || lower(l_linestatus) AS code
       FROM lineitem"""
)
def select_drop_add(spark, d):
    l = project.with_columns(
        table(spark, d, "lineitem"),
        {
            "difference": F.col("l_extendedprice") - F.col("l_quantity"),
            "doubled": F.col("l_quantity") * 2,
            "kind": F.lit("line"),
            "code": F.concat(F.upper("l_returnflag"), F.lit("-"), F.lower("l_linestatus")),
        },
    )
    rest = [c for c in l.columns if c.startswith("l_") and c not in ("l_orderkey", "l_linenumber")]
    return project.drop(l, rest)


@query("SELECT o_orderkey, o_totalprice / 2 AS half, o_orderstatus || '!' AS mark FROM orders")
def select_expressions(spark, d):
    return project.select_expr(
        table(spark, d, "orders"),
        ["o_orderkey", "o_totalprice / 2 AS half", "concat(o_orderstatus, '!') AS mark"],
    )


@query("SELECT o_orderstatus, count(*) AS rows, count(*) AS distinct_ids FROM orders GROUP BY 1")
def row_ids(spark, d):
    # The ids themselves are open; that they differ is not.
    o = project.row_id(table(spark, d, "orders"))
    return agg.group(
        o,
        ["o_orderstatus"],
        {"rows": F.count(F.lit(1)), "distinct_ids": F.count_distinct("row_id")},
    )


@query("SELECT c_custkey, c_name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS city FROM customer")
def flatten_map(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        F.create_map(
            F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")
        ).alias("about"),
    )
    return project.flatten(
        c, {"c_name": "about.name", "segment": "about.segment", "city": "about.city"}, ["c_custkey"]
    )


@query("SELECT p_partkey::DOUBLE AS p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM part")
def numeric_columns_only(spark, d):
    p = table(spark, d, "part")
    return p.select(*[F.col(c).cast("double").alias(c) for c in project.columns_of_type(p, T.NumericType)])


# -- scalar functions ----------------------------------------------------------------


@query(
    """WITH t AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%d-%m-%Y')
                    WHEN '5-LOW' THEN 'invalid' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS txt FROM orders),
            p AS (SELECT o_orderkey, txt, try_strptime(txt, '%Y-%m-%d') AS p FROM t)
       SELECT o_orderkey, txt, CASE WHEN length(txt) = 10 AND txt[5] = '-' THEN CAST(p AS DATE) END AS parsed,
         CASE WHEN length(txt) = 10 AND txt[5] = '-' THEN strftime(p, '%m/%d/%Y') ELSE 'Invalid Date' END AS shown
       FROM p"""
)
def try_parse_dates(spark, d):
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "dd-MM-yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", "invalid")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    o = table(spark, d, "orders").select("o_orderkey", text.alias("txt"))
    return project.with_columns(
        o,
        {
            "parsed": fn.try_parse_date("txt", "yyyy-MM-dd"),
            "shown": fn.try_parse_date("txt", "yyyy-MM-dd", "MM/dd/yyyy", "Invalid Date"),
        },
    )


@query(
    """SELECT event_id, strftime(ts, '%A') AS weekday, strftime(ts, '%a') AS short_weekday,
         strftime(ts, '%m/%d/%Y') AS us_date, hour(ts)::INT AS hour_of_day,
         date_diff('day', DATE '2024-01-01', ts::DATE)::INT AS day_no,
         round(epoch_us(ts - TIMESTAMP '2024-01-01') / 60000000.0, 3) AS minute_no,
         (ts - INTERVAL 3 DAY)::DATE AS three_days_before, (value > 10)::INT AS large,
         round(value, 1) AS rounded, coalesce(nullif(event_type, 'click'), 'none') AS kind,
         concat_ws('/', event_type, user_id::VARCHAR) AS path, split_part(event_type, 'i', 1) AS head
       FROM events"""
)
def scalar_functions(spark, d):
    e = table(spark, d, "events")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return e.select(
        "event_id",
        fn.weekday_name("ts", short=False).alias("weekday"),
        fn.weekday_name("ts").alias("short_weekday"),
        F.date_format("ts", "MM/dd/yyyy").alias("us_date"),
        F.hour("ts").alias("hour_of_day"),
        fn.date_gap("ts", F.lit("2024-01-01").cast("date")).alias("day_no"),
        F.round(fn.minutes_between(start, "ts"), 3).alias("minute_no"),
        (F.col("ts") - F.expr("INTERVAL 3 DAYS")).cast("date").alias("three_days_before"),
        (F.col("value") > 10).cast("int").alias("large"),
        F.round("value", 1).alias("rounded"),
        F.coalesce(F.nullif(F.col("event_type"), F.lit("click")), F.lit("none")).alias("kind"),
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("path"),
        fn.split_part_or_null("event_type", "i", 0).alias("head"),
    )


@query(
    """SELECT o_orderkey, o_orderdate::DATE AS from_iso, o_orderdate::DATE AS from_layout,
         o_orderdate AS from_text, strftime(o_orderdate, '%a') AS weekday FROM orders"""
)
def parse_text_dates(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("layout"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"),
    )
    return o.select(
        "o_orderkey",
        fn.parse_date("iso").alias("from_iso"),
        fn.parse_date("layout", "dd/MM/yyyy").alias("from_layout"),
        fn.parse_timestamp("stamp", "yyyy-MM-dd'T'HH:mm:ss").cast("timestamp_ntz").alias("from_text"),
        fn.weekday_name("stamp", "yyyy-MM-dd'T'HH:mm:ss").alias("weekday"),
    )
