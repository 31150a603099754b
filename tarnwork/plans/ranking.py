"""Window, ranking, sort and set queries."""

from pyspark.sql import functions as F

from tarnwork.operators import aggregate as agg
from tarnwork.operators import joins, project, window
from tarnwork.plans.registry import query, table


@query(
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_order_per_customer(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return window.latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"""
)
def earliest_order_per_customer(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return window.earliest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    """SELECT user_id, event_type, ts, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_event_per_user_and_type(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return window.latest(e, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    """SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS row_number
       FROM orders) WHERE row_number <= 3"""
)
def top3_orders_per_customer(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return window.top_n(o, ["o_custkey"], ["-o_totalprice", "o_orderkey"], 3, "row_number")


@query(
    """SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1
       ORDER BY o_orderpriority"""
)
def best_order_per_priority(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    best = window.top_n(o, ["o_orderpriority"], ["-o_totalprice", "o_orderkey"], 1)
    return window.sort(best, ["o_orderpriority"])


@query(
    """SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY o_totalprice DESC, o_orderdate, o_orderkey) AS row_number
       FROM orders"""
)
def numbered_orders(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    numbered = window.number_rows(o, ["o_custkey"], ["-o_totalprice", "o_orderdate", "o_orderkey"])
    return numbered.select("o_custkey", "o_orderkey", "row_number")


@query(
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM lineitem
       QUALIFY max(l_quantity) OVER (PARTITION BY l_returnflag) = l_quantity"""
)
def largest_lines_per_flag(spark, d):
    l = table(spark, d, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity"
    )
    return window.group_max_rows(l, ["l_returnflag"], "l_quantity")


@query(
    """SELECT c_mktsegment, o_orderkey, o_totalprice
       FROM orders JOIN customer ON o_custkey = c_custkey
       QUALIFY max(o_totalprice) OVER (PARTITION BY c_mktsegment) = o_totalprice"""
)
def max_order_per_segment_ties(spark, d):
    o = joins.join(
        table(spark, d, "orders"), table(spark, d, "customer"), {"o_custkey": "c_custkey"}
    ).select("c_mktsegment", "o_orderkey", "o_totalprice")
    return window.group_max_rows(o, ["c_mktsegment"], "o_totalprice")


@query(
    """SELECT o_custkey, o_orderkey,
         rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rank
       FROM orders"""
)
def rank_orders(spark, d):
    o = table(spark, d, "orders")
    return window.rank(o, ["o_custkey"], ["-o_orderdate"]).select("o_custkey", "o_orderkey", "rank")


@query(
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity,
         dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS dense_rank
       FROM lineitem"""
)
def dense_rank_lines(spark, d):
    l = table(spark, d, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity"
    )
    return window.dense_rank(l, ["l_returnflag"], ["-l_quantity"], many_ties=True)


@query(
    """SELECT * FROM (SELECT s_name, s_acctbal, rank() OVER (ORDER BY s_acctbal DESC)::INT AS rank
       FROM supplier) WHERE rank <= 5"""
)
def top_ranked_suppliers(spark, d):
    s = table(spark, d, "supplier").select("s_name", "s_acctbal")
    return window.top_ranked(s, ["-s_acctbal"], 5)


@query(
    """SELECT o_custkey, o_orderkey,
         round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), 2) AS running_total
       FROM orders"""
)
def running_total_range(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    r = window.running_sum(o, ["o_custkey"], ["o_orderdate"], "o_totalprice", "running_total")
    return r.select("o_custkey", "o_orderkey", F.round("running_total", 2).alias("running_total"))


@query(
    """SELECT user_id, event_id,
         round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_value
       FROM events"""
)
def running_total_rows(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    r = window.running_sum(e, ["user_id"], ["ts", "event_id"], "value", "running_value", "rows")
    return r.select("user_id", "event_id", F.round("running_value", 2).alias("running_value"))


@query(
    """WITH m AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month,
                    sum(o_totalprice) AS sales FROM orders GROUP BY 1, 2),
            r AS (SELECT o_orderpriority, month,
                    sum(sales) OVER (PARTITION BY o_orderpriority ORDER BY month) AS running_sales FROM m),
            t AS (SELECT o_orderpriority, sum(sales) AS total_sales FROM m GROUP BY 1)
       SELECT DISTINCT o_orderpriority, round(total_sales, 2) AS total_sales,
              round(running_sales, 2) AS running_sales
       FROM r JOIN t USING (o_orderpriority)"""
)
def monthly_running_and_total_sales(spark, d):
    o = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    monthly = agg.group(o, ["o_orderpriority", "month"], {"sales": F.sum("o_totalprice")})
    # One row per month is left of each priority.
    running = window.running_sum(
        monthly, ["o_orderpriority"], ["month"], "sales", "running_sales", hot_rows=None
    )
    both = agg.with_group_stats(
        running, ["o_orderpriority"], {"total_sales": F.sum("sales")}
    )
    return agg.distinct(
        both.select(
            "o_orderpriority",
            F.round("total_sales", 2).alias("total_sales"),
            F.round("running_sales", 2).alias("running_sales"),
        )
    )


@query(
    """SELECT user_id, event_id,
         round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_avg
       FROM events"""
)
def moving_avg_3(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    r = window.moving_avg(e, ["user_id"], ["ts", "event_id"], "value", 2)
    return r.select("user_id", "event_id", F.round("moving_avg", 4).alias("moving_avg"))


@query(
    """SELECT o_custkey, o_orderkey,
         lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_date
       FROM orders"""
)
def previous_order_date(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    p = window.previous(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "previous_date")
    return p.drop("o_orderdate")


@query(
    """SELECT o_custkey, o_orderkey,
         lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_price
       FROM orders"""
)
def next_order_price(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    n = window.following(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", "next_price")
    return n.select("o_custkey", "o_orderkey", "next_price")


@query(
    """SELECT user_id, event_id, min(value) OVER (PARTITION BY user_id ORDER BY ts) AS running_min
       FROM events"""
)
def running_min_value(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    return window.running_min(e, ["user_id"], ["ts"], "value").select(
        "user_id", "event_id", "running_min"
    )


@query(
    """SELECT p_partkey, p_retailprice, (SELECT min(p_retailprice) FROM part) AS min_value,
         (SELECT max(p_retailprice) FROM part) AS max_value FROM part"""
)
def parts_with_price_bounds(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return window.with_global_bounds(p, "p_retailprice")


@query(
    """SELECT c_custkey, c_name, c_acctbal, n_name,
         CASE WHEN c_acctbal = (SELECT max(c_acctbal) FROM customer) THEN 'Highest' ELSE 'Lowest' END AS balance_type
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       WHERE c_acctbal IN ((SELECT max(c_acctbal) FROM customer), (SELECT min(c_acctbal) FROM customer))"""
)
def extreme_balances(spark, d):
    c = window.extremes(table(spark, d, "customer"), "c_acctbal", {"max": "Highest", "min": "Lowest"}, "balance_type")
    n = table(spark, d, "nation")
    return joins.join(c, n, {"c_nationkey": "n_nationkey"}, "left").select(
        "c_custkey", "c_name", "c_acctbal", "n_name", "balance_type"
    )


@query(
    """SELECT p_partkey, p_retailprice, 'Highest' AS price_type FROM part
       WHERE p_retailprice = (SELECT max(p_retailprice) FROM part)
       UNION ALL SELECT p_partkey, p_retailprice, 'Lowest' FROM part
       WHERE p_retailprice = (SELECT min(p_retailprice) FROM part)"""
)
def extreme_priced_parts(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return window.extremes_union(p, "p_retailprice", {"max": "Highest", "min": "Lowest"}, "price_type")


@query(
    """(SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
       UNION ALL
       (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)"""
)
def union_top_bottom(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    top = window.top_k(o, ["-o_totalprice", "o_orderkey"], 5)
    bottom = window.top_k(o, ["o_totalprice", "o_orderkey"], 5)
    return window.union(top, bottom)


@query("SELECT s_nationkey, s_name FROM supplier ORDER BY s_nationkey DESC, s_name")
def sorted_suppliers(spark, d):
    s = project.select(table(spark, d, "supplier"), ["s_nationkey", "s_name"])
    return window.sort(s, ["-s_nationkey", "s_name"])


@query("SELECT least(count(*), 100) AS row_count FROM customer")
def limited_customers(spark, d):
    return agg.scalar_agg(
        window.limit(table(spark, d, "customer"), 100), {"row_count": F.count(F.lit(1))}
    )


@query("SELECT DISTINCT o_orderstatus FROM orders")
def distinct_statuses(spark, d):
    return agg.distinct(table(spark, d, "orders"), ["o_orderstatus"])
