"""Streams, quality rules, changing dimensions and the layered tables."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from tarnwork.operators import aggregate as agg
from tarnwork.operators import cdc, joins, quality
from tarnwork.plans import medallion
from tarnwork.plans.registry import query, table
from tarnwork.sources import readers, writers
from tarnwork.sources.storage import scratch_dir
from tarnwork.streaming import changes as change_streams
from tarnwork.streaming import flows

# -- quality rules -------------------------------------------------------------------

_RULES = {
    "known state": "length(o_orderstatus) = 1",
    "worth over nothing": "o_totalprice >= 0.01",
}
_DIRTY = """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_totalprice > 400000 THEN 'NA'
      ELSE o_orderstatus END AS o_orderstatus, o_totalprice - 50000 AS o_totalprice FROM orders"""


def _dirty_orders(spark, d):
    status = F.when(F.col("o_orderpriority") == "5-LOW", None).when(
        F.col("o_totalprice") > 400000, "NA"
    )
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", None)
        .otherwise(F.coalesce(status, F.col("o_orderstatus")))
        .alias("o_orderstatus"),
        (F.col("o_totalprice") - 50000).alias("o_totalprice"),
    )


@query(
    f"""SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM ({_DIRTY})
        WHERE length(o_orderstatus) = 1 AND o_totalprice >= 0.01"""
)
def expect_or_drop(spark, d):
    return quality.expect_all_or_drop(_dirty_orders(spark, d), _RULES).withColumn(
        "o_totalprice", F.round("o_totalprice", 2)
    )


@query(
    f"""SELECT o_orderkey, concat_ws(',', CASE WHEN NOT coalesce(length(o_orderstatus) = 1, false) THEN 'known state' END,
          CASE WHEN NOT coalesce(o_totalprice >= 0.01, false) THEN 'worth over nothing' END) AS failed_rules FROM ({_DIRTY})"""
)
def expect_or_warn(spark, d):
    w = quality.expect_all(_dirty_orders(spark, d), _RULES, "warn")
    return w.select("o_orderkey", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("SELECT o_orderkey FROM orders WHERE o_totalprice >= 0.01")
def expect_or_fail(spark, d):
    return quality.expect_all(table(spark, d, "orders"), _RULES, "fail").select("o_orderkey")


@query(
    f"""WITH r AS (SELECT coalesce(length(o_orderstatus) = 1, false) AS a, coalesce(o_totalprice >= 0.01, false) AS b
                   FROM ({_DIRTY}))
        SELECT 'known state' AS rule, count(*) FILTER (a) AS passed, count(*) FILTER (NOT a) AS failed FROM r
        UNION ALL SELECT 'worth over nothing', count(*) FILTER (b), count(*) FILTER (NOT b) FROM r"""
)
def rule_report(spark, d):
    return quality.rule_report(_dirty_orders(spark, d), _RULES)


# -- changing dimensions ---------------------------------------------------------------

# Each order is a change to its customer: the newest one tells the customer's status.
# Order keys make the sequence unique.
_CHANGES = """SELECT o_custkey AS c_custkey, o_orderstatus AS status, o_totalprice AS price,
     CASE WHEN o_totalprice > 499900 THEN 'wipe' WHEN o_orderpriority = '5-LOW' THEN 'gone' ELSE 'put' END AS change_kind,
     o_orderdate + o_orderkey * INTERVAL 1 MICROSECOND AS changed_at FROM orders"""
_KEYS, _SEQ = ["c_custkey"], "changed_at"
_DELETE, _TRUNCATE = "change_kind = 'gone'", "change_kind = 'wipe'"


def _changes(spark, d):
    micros = F.make_dt_interval(secs=(F.col("o_orderkey") / 1_000_000).cast("decimal(18,6)"))
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_totalprice") > 499900, "wipe")
        .when(F.col("o_orderpriority") == "5-LOW", "gone")
        .otherwise("put")
        .alias("change_kind"),
        (F.col("o_orderdate") + micros).alias(_SEQ),
    )


_SCD1 = f"""WITH c AS ({_CHANGES}), t AS (SELECT max(changed_at) AS t FROM c WHERE change_kind = 'wipe'),
    l AS (SELECT c.* FROM c, t WHERE change_kind <> 'wipe' AND (t IS NULL OR changed_at >= t)
          QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY changed_at DESC) = 1)
    SELECT * FROM l WHERE change_kind <> 'gone'"""
_SCD2 = f"""SELECT c_custkey, status, price, changed_at AS __START_AT,
    lead(changed_at) OVER (PARTITION BY c_custkey ORDER BY changed_at) AS __END_AT FROM ({_CHANGES})"""
_SCD2_DELETES = f"""SELECT * EXCLUDE (change_kind) FROM (
    SELECT c_custkey, status, price, change_kind, changed_at AS __START_AT,
    lead(changed_at) OVER (PARTITION BY c_custkey ORDER BY changed_at) AS __END_AT FROM ({_CHANGES}))
    WHERE change_kind <> 'gone'"""


def changes_of_customers(spark, d):
    """The feed with its keys, its sequence and the column that tells the kind of a change."""
    return _changes(spark, d), _KEYS, _SEQ, "change_kind"


@query(_SCD1)
def scd1_customers(spark, d):
    return cdc.scd1(_changes(spark, d), _KEYS, _SEQ, _DELETE, _TRUNCATE)


@query(_SCD2)
def scd2_customers(spark, d):
    return cdc.scd2(_changes(spark, d), _KEYS, _SEQ, [_SEQ, "change_kind"])


@query(_SCD2_DELETES)
def scd2_customers_with_deletes(spark, d):
    return cdc.scd2(_changes(spark, d), _KEYS, _SEQ, [_SEQ, "change_kind"], _DELETE)


@query(f"SELECT c_custkey, status, price FROM ({_SCD2}) WHERE __END_AT IS NULL")
def scd2_current(spark, d):
    return cdc.current(cdc.scd2(_changes(spark, d), _KEYS, _SEQ)).select("c_custkey", "status", "price")


@query(f"SELECT * FROM ({_SCD2}) WHERE c_custkey = 7 ORDER BY __START_AT")
def scd2_history_of_one(spark, d):
    return cdc.history(cdc.scd2(_changes(spark, d), _KEYS, _SEQ, [_SEQ, "change_kind"]), "c_custkey", 7)


@query(
    f"""SELECT c_custkey, status, o_orderkey FROM ({_SCD2}) LEFT JOIN
          (SELECT o_custkey, o_orderkey FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey
        WHERE __END_AT IS NULL"""
)
def scd2_current_join(spark, d):
    dim = cdc.scd2(_changes(spark, d), _KEYS, _SEQ, [_SEQ, "change_kind", "price"])
    o = table(spark, d, "orders").where("o_totalprice > 400000").select("o_custkey", "o_orderkey")
    return joins.join_current(dim, o, {"c_custkey": "o_custkey"}).select("c_custkey", "status", "o_orderkey")


def _stream_changes(spark, d, target, scd_type, truncate_when=None):
    """Feed the changes in two runs: inserts first, then deletes and truncates, all
    of which are older or newer than what has already arrived."""
    feed, path = _changes(spark, d), scratch_dir(spark, "changes")
    for part in ("change_kind = 'put'", "change_kind <> 'put'"):
        feed.where(part).write.mode("append").parquet(path)
        stream = readers.stream_files(spark, path, feed.schema, fmt="parquet")
        change_streams.apply_changes(
            stream, target, target + "-state", _KEYS, _SEQ, scd_type, truncate_when
        ).awaitTermination()


@query(_SCD1)
def scd1_stream(spark, d):
    path = scratch_dir(spark, "scd1")
    _stream_changes(spark, d, path, 1, _TRUNCATE)
    return change_streams.read_scd1(spark, path, _KEYS, _SEQ, _DELETE, _TRUNCATE)


@query(_SCD2)
def scd2_stream(spark, d):
    path = scratch_dir(spark, "scd2")
    _stream_changes(spark, d, path, 2)
    change_streams.compact_changes(spark, path, _KEYS, _SEQ, 2)
    return change_streams.read_scd2(spark, path, _KEYS, _SEQ, [_SEQ, "change_kind"])


# -- streams ---------------------------------------------------------------------------


def _order_stream(spark, d):
    schema = table(spark, d, "orders").schema
    return readers.stream_files(spark, f"{d}/orders.parquet", schema, fmt="parquet")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_only_stream(spark, d):
    root, name = scratch_dir(spark, "append"), f"orders_stream_{uuid.uuid4().hex[:12]}"
    src = _order_stream(spark, d)
    flows.append_stream(src, name, root + "/state", root + "/table").awaitTermination()
    return readers.scan_table(spark, name).select("o_orderkey", "o_orderstatus", "o_totalprice")


_PROFILE = """SELECT o_orderstatus, count(*) AS order_count, round(sum(o_totalprice), 2) AS total FROM {} GROUP BY 1"""


def _profile(df):
    return agg.group(
        df,
        ["o_orderstatus"],
        {"order_count": F.count(F.lit(1)), "total": F.round(F.sum("o_totalprice"), 2)},
    )


_HINTS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def _csv_order_stream(spark, d):
    path = scratch_dir(spark, "orders-csv")
    table(spark, d, "orders").write.option("header", True).csv(path)
    return readers.stream_files(spark, path, _HINTS, pattern="*.csv")


@query(_PROFILE.format("orders"))
def file_stream(spark, d):
    root = scratch_dir(spark, "file-stream")
    flows.append_flows(root + "/t", {"files": _csv_order_stream(spark, d)}, root + "/state")
    return _profile(flows.read_flows(spark, root + "/t"))


@query(_PROFILE.format("(SELECT * FROM orders UNION ALL SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')"))
def append_flows(spark, d):
    root, name = scratch_dir(spark, "flows"), f"orders_f_{uuid.uuid4().hex[:12]}"
    writers.save_table(table(spark, d, "orders").where("o_orderstatus = 'F'"), name, path=root + "/f")

    def run():
        streams = {
            "parquet": _order_stream(spark, d),
            "files": files,
            "table": readers.stream_table(spark, name),
        }
        flows.append_flows(root + "/t", streams, root + "/state")

    files = _csv_order_stream(spark, d)
    run()
    run()  # nothing new: nothing is added
    return _profile(flows.read_flows(spark, root + "/t"))


@query(
    """SELECT 'before' AS moment, 0::BIGINT AS row_count, NULL::BIGINT AS key_sum
       UNION ALL SELECT 'after', count(*), sum(o_orderkey)::BIGINT FROM orders"""
)
def empty_target_filled_later(spark, d):
    """A target that is empty until its flow has run, read with its schema both times."""
    root, schema = scratch_dir(spark, "empty-target"), table(spark, d, "orders").schema

    def told(moment):
        rows = flows.read_flows(spark, root + "/t", schema=schema)
        sums = agg.scalar_agg(rows, {"row_count": F.count(F.lit(1)), "key_sum": F.sum("o_orderkey")})
        return sums.select(F.lit(moment).alias("moment"), "row_count", "key_sum")

    before = told("before")
    flows.append_flows(root + "/t", {"orders": _order_stream(spark, d)}, root + "/state")
    return before.unionByName(told("after"))


# -- layered tables ----------------------------------------------------------------------


def _new_schema():
    return f"layers_{uuid.uuid4().hex[:12]}"


def _layers(spark, d, dim, facts, schema=None, **more):
    """Run a flow whose dimension is a table of the test data, put once."""
    root, schema = scratch_dir(spark, "layers"), schema or _new_schema()
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{root}/schema'")
    feed = dim.withColumns(
        {"change_kind": F.lit("put"), "changed_at": F.lit("2024-01-01").cast("timestamp_ntz")}
    )
    feed.write.parquet(root + "/dimension")
    spec = medallion.LayerSpec(
        dimension=readers.stream_files(spark, root + "/dimension", feed.schema, fmt="parquet"),
        facts=facts,
        root=root,
        schema=schema,
        seq="changed_at",
        delete_when="change_kind = 'gone'",
        except_cols=["change_kind", "changed_at"],
        **more,
    )
    return medallion.run_layers(spark, spec)


def _orders_by_segment(spark, d, states, schema=None):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    return _layers(
        spark,
        d,
        table(spark, d, "customer").select("c_custkey", "c_name", segment),
        {"parquet": _order_stream(spark, d), "files": _csv_order_stream(spark, d)},
        schema,
        keys=["c_custkey"],
        on={"c_custkey": "o_custkey"},
        by=["c_mktsegment"],
        measures={"n_orders": F.count("o_orderkey"), "worth": F.sum("o_totalprice")},
        dimension_rules={"has a segment": "length(c_mktsegment) > 0"},
        fact_rules={**_RULES, "not tiny": "o_totalprice > 10000"},
        split_by="o_orderstatus",
        split_values=states,
        names={"rollup": "segments"},
    )


_DETAIL = """(SELECT c.*, o.* FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c LEFT JOIN
    (SELECT * FROM orders WHERE o_totalprice > 10000 UNION ALL SELECT * FROM orders WHERE o_totalprice > 10000) o
    ON c_custkey = o_custkey)"""


@query(
    f"""SELECT c_mktsegment, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS worth
        FROM {_DETAIL} GROUP BY 1"""
)
def medallion_gold(spark, d):
    rollup = _orders_by_segment(spark, d, ["O"])["rollup"]
    return rollup.withColumn("worth", F.round("worth", 2))


@query(
    f"""SELECT o_orderstatus, c_mktsegment, count(o_orderkey) AS n_orders,
          round(sum(o_totalprice), 2) AS worth
        FROM {_DETAIL} WHERE o_orderstatus IN ('O', 'F') GROUP BY 1, 2"""
)
def gold_by_status(spark, d):
    tables = _orders_by_segment(spark, d, ["O", "F"])
    both = [tables[f"rollup_{s}"].withColumn("o_orderstatus", F.lit(s)) for s in ("O", "F")]
    return both[0].unionByName(both[1]).withColumn("worth", F.round("worth", 2))


@query(
    """SELECT s_nationkey, count(l_orderkey) AS n_lines, max(l_quantity) AS largest
       FROM supplier LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity < 40) ON s_suppkey = l_suppkey
       GROUP BY 1"""
)
def layers_of_suppliers(spark, d):
    lines = table(spark, d, "lineitem")
    stream = readers.stream_files(spark, f"{d}/lineitem.parquet", lines.schema, fmt="parquet")
    built = _layers(
        spark,
        d,
        table(spark, d, "supplier").select("s_suppkey", "s_nationkey"),
        {"lines": stream.select("l_orderkey", "l_suppkey", "l_quantity")},
        keys=["s_suppkey"],
        on={"s_suppkey": "l_suppkey"},
        by=["s_nationkey"],
        measures={"n_lines": F.count("l_orderkey"), "largest": F.max("l_quantity")},
        fact_rules={"small": "l_quantity < 40"},
        stamp=None,
    )
    return built["rollup"]


@query(
    """SELECT c_mktsegment, count(*) AS versions, max(c_custkey) AS last_key FROM customer
       WHERE c_mktsegment <> 'BUILDING' GROUP BY 1"""
)
def named_view_between_tables(spark, d):
    """The versions of the dimension, a view by name between the store and the detail."""
    _orders_by_segment(spark, d, ["O"])
    return spark.sql(
        "SELECT c_mktsegment, count(*) AS versions, max(c_custkey) AS last_key FROM versions"
        " WHERE __END_AT IS NULL GROUP BY c_mktsegment"
    )


@query(
    f"""SELECT 'detail' AS table_name, 'detail' AS layer, 'open versions with their facts' AS comment,
          count(*) AS row_count FROM {_DETAIL}
        UNION ALL SELECT 'segments', 'rollup', 'by c_mktsegment', count(DISTINCT c_mktsegment) FROM {_DETAIL}
        UNION ALL SELECT 'by_value', 'rollup', 'by o_orderstatus', count(*)
          FROM (SELECT DISTINCT o_orderstatus, c_mktsegment FROM {_DETAIL} WHERE o_orderstatus IN ('F', 'O'))
        UNION ALL SELECT 'rollup_' || lower(s), 'rollup', 'o_orderstatus ' || s,
          (SELECT count(DISTINCT c_mktsegment) FROM {_DETAIL} WHERE o_orderstatus = s) FROM (VALUES ('F'), ('O')) v(s)"""
)
def layer_catalogue(spark, d):
    """Layer tags and comments as the catalogue has them, beside the rows of each table."""
    schema = _new_schema()
    built = _orders_by_segment(spark, d, ["O", "F"], schema)
    named = {"detail": "detail", "segments": "rollup", "by_value": "by_value", "rollup_o": "rollup_O", "rollup_f": "rollup_F"}
    counts = [
        agg.scalar_agg(built[of], {"row_count": F.count(F.lit(1))}).withColumn("table_name", F.lit(name))
        for name, of in named.items()
    ]
    sizes = reduce(lambda a, b: a.unionByName(b), counts)
    tables = readers.catalogue(spark, schema, ["layer"]).where("NOT is_view")
    return joins.join(tables, sizes, "table_name").select("table_name", "layer", "comment", "row_count")
