"""Scans, writes and incremental loads. Everything written goes to a new folder
under the shared folder of the session."""

import uuid

from pyspark.sql import Row
from pyspark.sql import functions as F

from tarnwork.operators import aggregate as agg
from tarnwork.operators import joins
from tarnwork.plans.registry import query, table
from tarnwork.sources import incremental, readers, writers
from tarnwork.sources.storage import scratch_dir

def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def _order_profile(df):
    return agg.group(
        df,
        ["o_orderstatus"],
        {
            "order_count": F.count(F.lit(1)),
            "total": F.round(F.sum("o_totalprice"), 2),
            "key_sum": F.sum("o_orderkey"),
        },
    )


_PROFILE = """SELECT o_orderstatus, count(*) AS order_count, round(sum(o_totalprice), 2) AS total,
   sum(o_orderkey)::BIGINT AS key_sum FROM {} GROUP BY 1"""


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, d):
    path = scratch_dir(spark, "customer-csv")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    c.write.option("header", True).csv(path)
    return readers.scan_csv(spark, path, schema=c.schema)


@query("SELECT s_suppkey::INT AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_inferred(spark, d):
    path = scratch_dir(spark, "supplier-csv")
    table(spark, d, "supplier").write.option("header", True).option("sep", "|").csv(path)
    return readers.scan_csv(spark, path, infer=True, options={"sep": "|"})


@query("SELECT c_custkey, c_name FROM customer")
def directory_as_table(spark, d):
    path = scratch_dir(spark, "customer-parquet")
    writers.write_files(table(spark, d, "customer"), path)
    return readers.scan_path_sql(spark, path).select("c_custkey", "c_name")


@query(_PROFILE.format("orders WHERE o_orderstatus = 'F'"))
def write_if_any(spark, d):
    o = table(spark, d, "orders")
    full, empty = _name("orders_f"), _name("orders_none")
    path = scratch_dir(spark, full)
    writers.write_table_if_any(o.where("o_orderstatus = 'F'"), full, path)
    if writers.write_table_if_any(o.where("o_orderstatus = 'none'"), empty) != 0:
        raise AssertionError("an empty result must not be written")
    return _order_profile(readers.scan_table(spark, full))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def create_table_as_select(spark, d):
    name = _name("supplier_copy")
    return writers.ctas(spark, name, table(spark, d, "supplier"), scratch_dir(spark, name))


@query(_PROFILE.format("(SELECT * FROM orders UNION ALL SELECT 1, 1, 'X', 9.5, NULL, NULL)"))
def clone_and_append(spark, d):
    src, dst = _name("orders_src"), _name("orders_dst")
    writers.save_table(table(spark, d, "orders"), src, path=scratch_dir(spark, src))
    writers.clone_table(spark, src, dst, scratch_dir(spark, dst))
    writers.append_rows(spark, dst, [(1, 1, "X", 9.5, None, None)])
    return _order_profile(readers.scan_table(spark, dst))


@query("SELECT count(*) + 10 AS row_count FROM orders")
def append_limited_query(spark, d):
    name = _name("orders_more")
    o = table(spark, d, "orders")
    writers.save_table(o, name, path=scratch_dir(spark, name))
    writers.append_query(spark, name, o, limit=10)
    return readers.row_count(readers.scan_table(spark, name))


@query(
    """SELECT c_custkey, 0.5::DOUBLE AS weight, TIMESTAMP '2024-01-01' AS added_at,
         CAST(NULL AS VARCHAR) AS note FROM customer"""
)
def add_columns(spark, d):
    return writers.add_columns(
        table(spark, d, "customer").select("c_custkey"),
        {
            "weight": F.lit(0.5),
            "added_at": F.lit("2024-01-01").cast("timestamp_ntz"),
            "note": "string",
        },
    )


def _files_in_two_shapes(spark, d, path):
    """Orders as CSV files: some with all columns, some with fewer, in another order."""
    o = table(spark, d, "orders")
    wide = o.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_totalprice")
    narrow = o.where("o_orderstatus = 'P'").select("o_orderstatus", "o_orderkey")
    wide.write.mode("append").option("header", True).csv(path)
    narrow.write.mode("append").option("header", True).csv(path)


@query(
    """SELECT o_orderstatus, count(*) AS order_count, count(*) FILTER (o_orderstatus <> 'P') AS priced,
         sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1"""
)
def load_new_files(spark, d):
    src, target, state = (scratch_dir(spark, n) for n in ("landing", "loaded", "load-state"))
    _files_in_two_shapes(spark, d, src)
    load = lambda: incremental.load_new_files(spark, src, target, state, pattern="*.csv")
    load()
    if load() != 0:
        raise AssertionError("a file was loaded twice")
    rows = incremental.read_loaded(spark, target)
    return agg.group(
        rows,
        ["o_orderstatus"],
        {
            "order_count": F.count(F.lit(1)),
            "priced": F.count("o_totalprice"),
            "key_sum": F.sum(F.col("o_orderkey").cast("long")),
        },
    )


@query("SELECT o_orderkey, o_orderstatus, true AS stamped FROM orders")
def load_new_files_projected(spark, d):
    src, target, state = (scratch_dir(spark, n) for n in ("landing", "loaded", "load-state"))
    _files_in_two_shapes(spark, d, src)
    incremental.load_new_files(
        spark,
        src,
        target,
        state,
        pattern="*.csv",
        select=["o_orderkey", "o_orderstatus"],
        add_load_ts="_insert_date",
    )
    rows = incremental.read_loaded(spark, target)
    return rows.select(
        F.col("o_orderkey").cast("long").alias("o_orderkey"),
        "o_orderstatus",
        F.col("_insert_date").isNotNull().alias("stamped"),
    )


@query(
    """WITH s AS (SELECT count(*) AS rows, sum(strlen(to_json(customer)::VARCHAR))::BIGINT AS bytes FROM customer)
       SELECT rows, bytes, bytes / 1048576 AS mb, bytes / 1073741824 AS gb FROM s"""
)
def estimate_bytes(spark, d):
    return writers.estimate_bytes(table(spark, d, "customer"))


@query(
    """WITH s AS (SELECT strlen(to_json(c)::VARCHAR) AS b FROM (SELECT * FROM customer LIMIT 1000) c)
       SELECT least((SELECT count(*) FROM customer),
                    floor(0.05 * 1048576 * count(*) / sum(b))::BIGINT) AS row_count FROM s"""
)
def limit_to_bytes(spark, d):
    # Which rows are kept is open; how many are is not.
    return readers.row_count(writers.limit_to_bytes(table(spark, d, "customer"), 0.05))


@query("SELECT 'O,F' AS order_status, count(*) AS orders FROM orders WHERE o_orderstatus IN ('O', 'F')")
def parameter_table(spark, d):
    params = readers.param_table(spark, "tarnwork.orderStatus", "O,F", "order_status")
    wanted = params.select(F.explode(F.split("order_status", ",")).alias("o_orderstatus"))
    matching = table(spark, d, "orders").join(wanted, "o_orderstatus", "left_semi")
    counted = readers.row_count(matching).select(F.col("row_count").alias("orders"))
    return counted.withColumn("order_status", params.scalar())


@query(
    """SELECT code, meaning, count(*) AS orders FROM orders
       JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'part')) t(code, meaning) ON o_orderstatus = code
       GROUP BY 1, 2"""
)
def literal_lookup(spark, d):
    names = readers.literal_table(
        spark, [("F", "finished"), ("O", "open"), ("P", "part")], ["code", "meaning"]
    )
    o = table(spark, d, "orders")
    return agg.group(
        o.join(names, o["o_orderstatus"] == names["code"]),
        ["code", "meaning"],
        {"orders": F.count(F.lit(1))},
    )


@query(
    """SELECT id, count(o_orderkey) AS orders FROM (SELECT unnest(range(1, 13)) AS id)
       LEFT JOIN orders ON month(o_orderdate) = id GROUP BY 1"""
)
def orders_per_month_number(spark, d):
    months = readers.id_range(spark, 1, 13)
    o = table(spark, d, "orders").withColumn("month_no", F.month("o_orderdate").cast("long"))
    counts = agg.group(o, ["month_no"], {"orders": F.count("o_orderkey")})
    joined = months.join(counts, months["id"] == counts["month_no"], "left")
    return joined.select("id", F.coalesce("orders", F.lit(0)).alias("orders"))


# -- literal tables, columns and schemas ---------------------------------------------


@query(
    """SELECT o_orderkey, s.meaning, s.weight FROM orders
       JOIN (VALUES ('F', 'filled', 1.0::DOUBLE), ('O', 'open', 2.5::DOUBLE), ('P', NULL, NULL)) s(code, meaning, weight)
       ON o_orderstatus = s.code"""
)
def literal_with_schema(spark, d):
    """States spelled out from a table with a fixed schema, NULL values included."""
    states = readers.literal_table(
        spark, [("F", "filled", 1.0), ("O", "open", 2.5), ("P", None, None)], "code string, meaning string, weight double"
    )
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return joins.join(o, states, {"o_orderstatus": "code"}).select("o_orderkey", "meaning", "weight")


@query(
    """SELECT o_orderpriority, count(*) AS order_count, max(w.days) AS days, max(w.note) AS note
       FROM orders JOIN (VALUES ('1-URGENT', 1, 'row'), ('2-HIGH', 3, 'dict'), ('5-LOW', 0, 'scalar')) w(name, days, note)
       ON o_orderpriority = w.name GROUP BY 1"""
)
def literal_from_rows_dicts_scalars(spark, d):
    """Priorities from ``Row`` objects, dicts and plain scalars in one union."""
    of_rows = readers.literal_table(spark, [Row(name="1-URGENT", days=1, note="row")])
    of_dicts = readers.literal_table(spark, [{"name": "2-HIGH", "days": 3, "note": "dict"}])
    of_scalars = readers.literal_table(spark, ["5-LOW"], "string").toDF("name")
    of_scalars = of_scalars.withColumns({"days": F.lit(0).cast("long"), "note": F.lit("scalar")})
    every = of_rows.unionByName(of_dicts).unionByName(of_scalars)
    joined = joins.join(table(spark, d, "orders"), every, {"o_orderpriority": "name"})
    return agg.group(
        joined,
        ["o_orderpriority"],
        {"order_count": F.count(F.lit(1)), "days": F.max("days").cast("int"), "note": F.max("note")},
    )


@query(
    """SELECT (row_number() OVER () - 1)::INT AS pos, column_name AS col_name,
         CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
           WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' END AS data_type
       FROM (DESCRIBE orders)"""
)
def columns_of_orders(spark, d):
    return readers.describe_columns(table(spark, d, "orders"))


@query(
    """SELECT count(*) AS supplier_count, 'suppliers'' own \\ copy' AS schema_comment,
         count(DISTINCT s_nationkey) AS nation_count FROM supplier"""
)
def schema_with_comment(spark, d):
    """A schema made once, although asked for twice, with a comment full of quotes; a table in it."""
    schema = _name("shop")
    for _ in range(2):
        writers.create_schema(spark, schema, "suppliers' own \\ copy")
    copy = writers.ctas(spark, f"{schema}.supplier", table(spark, d, "supplier"), scratch_dir(spark, schema))
    told = F.lit(spark.catalog.getDatabase(schema).description)
    return agg.scalar_agg(
        copy,
        {
            "supplier_count": F.count(F.lit(1)),
            "schema_comment": F.max(told),
            "nation_count": F.count_distinct("s_nationkey"),
        },
    )
