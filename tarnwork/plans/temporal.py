"""Time-series queries."""

from pyspark.sql import functions as F

from tarnwork.operators import timeseries as ts
from tarnwork.plans.registry import query, table


def _orders(spark, d, *cols):
    return table(spark, d, "orders").select(*(cols or ("o_custkey", "o_orderkey", "o_orderdate")))


def _events(spark, d):
    return table(spark, d, "events").select("user_id", "event_id", "ts")


@query(
    """WITH g AS (SELECT o_custkey, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate),
                    o_orderdate) AS gap FROM orders)
       SELECT o_custkey, round(avg(gap), 6) AS avg_days FROM g GROUP BY 1"""
)
def avg_order_interval(spark, d):
    return ts.avg_interval(_orders(spark, d), "o_custkey", "o_orderdate").select(
        "o_custkey", F.round("avg_days", 6).alias("avg_days")
    )


@query(
    """WITH g AS (SELECT o_custkey, o_orderdate, lag(o_orderdate) OVER w AS prev_date,
                    date_diff('day', lag(o_orderdate) OVER w, o_orderdate)::INT AS gap_days
                  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate))
       SELECT * FROM g WHERE gap_days > 400"""
)
def order_gaps_over_400_days(spark, d):
    return ts.gaps_over(_orders(spark, d, "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", 400)


@query(
    """WITH g AS (SELECT user_id, event_id, ts, lag(ts) OVER w AS prev_ts,
                    epoch_us(ts - lag(ts) OVER w) / 60000000.0 AS m
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
       SELECT user_id, event_id, ts, prev_ts, round(m, 4) AS gap_minutes FROM g WHERE m < 10"""
)
def rapid_repeats(spark, d):
    r = ts.rapid_repeats(_events(spark, d), "user_id", "ts", 10)
    return r.withColumn("gap_minutes", F.round("gap_minutes", 4))


@query(
    """WITH g AS (SELECT user_id, event_id, ts, lead(ts) OVER w AS next_ts,
                    epoch_us(lead(ts) OVER w - ts) / 60000000.0 AS m
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
       SELECT user_id, event_id, ts, next_ts, round(m, 4) AS gap_minutes, true AS suspicious FROM g WHERE m < 5"""
)
def rapid_followed(spark, d):
    r = ts.rapid_followed(_events(spark, d), "user_id", "ts", 5).where("suspicious")
    return r.withColumn("gap_minutes", F.round("gap_minutes", 4))


@query(
    """WITH g AS (SELECT user_id, event_id, coalesce(epoch_us(ts - lag(ts) OVER w) / 60000000.0, 0) AS m
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
       SELECT user_id, event_id, (CASE WHEN m < 30 THEN 1 ELSE 2 END)::INT AS gap_flag FROM g"""
)
def gap_flag(spark, d):
    return ts.gap_flag(_events(spark, d), "user_id", "ts", 30).select("user_id", "event_id", "gap_flag")


_SESSIONS = """WITH g AS (SELECT user_id, event_id, ts, epoch_us(ts - lag(ts) OVER w) AS us
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, event_id, ts,
            sum(CASE WHEN us <= 30 * 60000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts)::BIGINT
              AS session_id FROM g)"""


@query(_SESSIONS + " SELECT user_id, event_id, session_id FROM s")
def sessions(spark, d):
    return ts.sessionize(_events(spark, d), "user_id", "ts", 30).select(
        "user_id", "event_id", "session_id"
    )


@query(
    _SESSIONS
    + """ SELECT user_id, session_id, min(ts) AS session_start, max(ts) AS session_end,
            count(*) AS activity_count FROM s GROUP BY 1, 2"""
)
def session_summary(spark, d):
    return ts.session_summary(_events(spark, d), "user_id", "ts", 30)


_DAYS = "days AS (SELECT DISTINCT user_id, ts::DATE AS ts FROM events)"


@query(
    f"""WITH {_DAYS}, g AS (SELECT user_id, ts, date_diff('day', lag(ts) OVER w, ts) AS gap FROM days
                           WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
          s AS (SELECT user_id, ts, sum(CASE WHEN gap = 1 THEN 0 ELSE 1 END)
                  OVER (PARTITION BY user_id ORDER BY ts)::BIGINT AS streak_id FROM g)
        SELECT user_id, streak_id, min(ts) AS from_day, max(ts) AS to_day,
          (date_diff('day', min(ts), max(ts)) + 1)::INT AS n_days FROM s GROUP BY 1, 2"""
)
def active_day_streaks(spark, d):
    return ts.streaks(_events(spark, d), "user_id", "ts")


_SPINE = f"""WITH {_DAYS}, b AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM days GROUP BY 1),
    spine AS (SELECT user_id, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM b),
    missing AS (SELECT user_id, day FROM spine ANTI JOIN days ON spine.user_id = days.user_id AND spine.day = days.ts)"""


@query(_SPINE + " SELECT user_id, day AS spine_date FROM spine")
def date_spine(spark, d):
    return ts.date_spine(_events(spark, d), "user_id", "ts")


@query(_SPINE + " SELECT user_id, day AS missing_date FROM missing")
def missing_dates(spark, d):
    return ts.missing_dates(_events(spark, d), "user_id", "ts")


@query(
    _SPINE
    + """, i AS (SELECT user_id, day, day - (row_number() OVER (PARTITION BY user_id ORDER BY day))::INT AS island
                 FROM missing)
        SELECT user_id, min(day) AS missing_from, max(day) AS missing_to FROM i GROUP BY user_id, island"""
)
def missing_ranges(spark, d):
    return ts.missing_ranges(_events(spark, d), "user_id", "ts")


@query(
    _SPINE
    + " SELECT user_id, min(day) AS missing_from, max(day) AS missing_to FROM missing GROUP BY user_id"
)
def missing_envelope(spark, d):
    return ts.missing_envelope(_events(spark, d), "user_id", "ts")


@query(
    """WITH f AS (SELECT user_id, event_id, ts, date_diff('day', (min(ts) OVER (PARTITION BY user_id))::DATE, ts::DATE)::INT AS day_n
                  FROM events)
       SELECT user_id, event_id, ts, day_n FROM f WHERE day_n IN (1, 7, 30)"""
)
def retention_1_7_30(spark, d):
    return ts.retention(_events(spark, d), "user_id", "ts").drop("first_date")


_LIFE = """WITH a AS (SELECT user_id, min(ts) AS signed_up FROM events WHERE event_type = 'signup' GROUP BY 1),
    p AS (SELECT user_id, ts AS bought FROM events WHERE event_type = 'purchase')"""


def _life(spark, d):
    e = table(spark, d, "events")
    signups = (
        e.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("signed_up"))
    )
    return signups, e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"))


@query(
    _LIFE
    + """ SELECT user_id, signed_up, min(bought) AS bought,
            date_diff('day', signed_up::DATE, min(bought)::DATE)::INT AS days_to_first
          FROM a JOIN p USING (user_id) GROUP BY 1, 2"""
)
def signup_to_first_purchase(spark, d):
    return ts.days_to_first(*_life(spark, d), "user_id", "signed_up", "bought")


@query(
    _LIFE
    + """ SELECT user_id, signed_up, min(bought) AS bought,
            date_diff('day', signed_up::DATE, min(bought)::DATE)::INT AS days_to_first
          FROM a JOIN p USING (user_id) WHERE bought >= signed_up GROUP BY 1, 2"""
)
def signup_to_next_purchase(spark, d):
    return ts.days_to_first(*_life(spark, d), "user_id", "signed_up", "bought", only_after=True)


@query(
    """WITH b AS (SELECT *, min(o_orderdate) OVER w AS lo, max(o_orderdate) OVER w AS hi FROM orders
                  WINDOW w AS (PARTITION BY o_custkey))
       SELECT o_custkey, o_orderkey, o_orderdate FROM b WHERE o_orderdate IN (lo, hi)"""
)
def first_and_last_order(spark, d):
    return ts.first_and_last(_orders(spark, d), "o_custkey", "o_orderdate")


@query(
    """WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice,
                    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)::INT AS recency
                  FROM orders QUALIFY recency <= 2)
       SELECT o_custkey, o_orderkey, recency, round(lag(o_totalprice)
         OVER (PARTITION BY o_custkey ORDER BY recency) - o_totalprice, 2) AS change FROM r"""
)
def latest_change(spark, d):
    o = _orders(spark, d, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    c = ts.latest_change(o, "o_custkey", ["-o_orderdate", "-o_orderkey"], "o_totalprice")
    return c.select("o_custkey", "o_orderkey", "recency", F.round("change", 2).alias("change"))


@query(
    """WITH c AS (SELECT strftime(ts, '%A') AS weekday,
         CASE WHEN hour(ts) BETWEEN 5 AND 10 THEN 'breakfast' WHEN hour(ts) BETWEEN 11 AND 13 THEN 'lunch'
              WHEN hour(ts) BETWEEN 14 AND 19 THEN 'coffee and dinner' ELSE 'night' END AS band,
         count(*) AS events FROM events GROUP BY 1, 2)
       SELECT * FROM (SELECT *, rank() OVER (ORDER BY events DESC)::INT AS rank FROM c) WHERE rank <= 5"""
)
def busiest_weekday_daypart(spark, d):
    bands = [(5, "breakfast"), (11, "lunch"), (14, "coffee and dinner"), (20, "night")]
    return ts.busiest_buckets(table(spark, d, "events"), "ts", bands, 5)
