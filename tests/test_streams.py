"""Streams, incremental loads and the layered tables over several runs."""

import datetime as dt
import gzip
import uuid

import pytest
from pyspark.sql import functions as F

from tarnwork.operators import cdc
from tarnwork.plans import medallion
from tarnwork.sources import incremental, readers, writers
from tarnwork.streaming import changes, flows

TS = dt.datetime
SCHEMA = "k int, text string, act string, seq timestamp_ntz"


def name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def write_csv(path, header, *lines):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_text("\n".join([header, *lines]) + "\n")


def test_load_only_new_files(spark, tmp_path, rows):
    src, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    load = lambda **k: incremental.load_new_files(spark, src, target, state, pattern="*.csv", **k)
    write_csv(tmp_path / "in/a.csv", "InvoiceNo,StockCode", "1,x", "2,y")
    (tmp_path / "in/notes.txt").write_text("InvoiceNo,StockCode\n9,z\n")
    assert load() == 2
    assert load() == 0
    # Another column, another order, and a quoted comma in the header.
    write_csv(tmp_path / "in/b.csv", 'StockCode,InvoiceNo,"Unit, price"', "z,3,4.5")
    assert load() == 1
    got = incremental.read_loaded(spark, target)
    assert rows(got, "InvoiceNo", "StockCode", "`Unit, price`") == [
        ("1", "x", None), ("2", "y", None), ("3", "z", "4.5"),
    ]


def test_load_in_batches_and_old_files(spark, tmp_path):
    import os

    src, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i in range(5):
        write_csv(tmp_path / f"in/f{i}.csv", "a", str(i))
    load = lambda: incremental.load_new_files(spark, src, target, state, files_per_batch=2)
    assert load() == 5
    write_csv(tmp_path / "in/late.csv", "a", "99")
    os.utime(tmp_path / "in/late.csv", (0, 0))  # much older than what was loaded
    assert load() == 1
    assert incremental.read_loaded(spark, target).count() == 6


def test_load_with_projection_and_schema(spark, tmp_path, rows):
    src, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_csv(tmp_path / "in/a.csv", "id,name,extra", "1,x,q")
    incremental.load_new_files(spark, src, target, state, select=["id", "absent"], add_load_ts="_insert_date")
    got = incremental.read_loaded(spark, target)
    assert got.columns == ["id", "absent", "_insert_date"]
    assert rows(got, "id", "absent") == [("1", None)]
    typed = str(tmp_path / "typed")
    incremental.load_new_files(spark, src, typed, state + "2", schema="id int, name string, extra string")
    assert incremental.read_loaded(spark, typed).dtypes[0] == ("id", "int")
    assert incremental.read_loaded(spark, str(tmp_path / "nothing")) is None


def test_parquet_load_merges_schemas(spark, tmp_path):
    src, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(src)
    spark.createDataFrame([(2, "x")], "a int, b string").coalesce(1).write.mode("append").parquet(src)
    assert incremental.load_new_files(spark, src, target, state, fmt="parquet", pattern="*.parquet") == 2
    assert sorted(incremental.read_loaded(spark, target).columns) == ["a", "b"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """The state is set back to before the last batch, as after a crash between the
    write and the commit."""
    src, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_csv(tmp_path / "in/a.csv", "a", "1", "2")
    incremental.load_new_files(spark, src, target, state)
    for f in (tmp_path / "state/commits").iterdir():
        if f.name.lstrip(".").startswith("0"):
            f.unlink()
    assert incremental.load_new_files(spark, src, target, state) == 2
    assert incremental.read_loaded(spark, target).count() == 2


def test_tables(spark, tmp_path, rows):
    src, dst, empty = name("src"), name("dst"), name("none")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    assert writers.write_table_if_any(df, src, str(tmp_path / src)) == 2
    assert writers.write_table_if_any(df.where("id > 5"), empty) == 0
    assert not spark.catalog.tableExists(empty)
    writers.clone_table(spark, src, dst, str(tmp_path / dst))
    writers.append_rows(spark, dst, [(3, None)])
    writers.append_query(spark, dst, df, limit=1)
    writers.clone_table(spark, src, dst)  # exists: nothing happens
    assert readers.scan_table(spark, src).count() == 2
    assert readers.scan_table(spark, dst).count() == 4
    with pytest.raises(Exception, match="already exists"):
        writers.ctas(spark, dst, df)
    schema = name("s")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/{schema}'")
    assert rows(writers.ctas(spark, f"{schema}.copy", df)) == [(1, "a"), (2, "b")]
    writers.write_files(df, str(tmp_path / "dir"))
    writers.write_files(df.where("id = 1"), str(tmp_path / "dir"))
    assert rows(readers.scan_path_sql(spark, str(tmp_path / "dir"))) == [(1, "a")]
    more = writers.add_columns(df, {"note": "string", "act": F.lit("I")})
    assert more.dtypes[2:] == [("note", "string"), ("act", "string")]


def test_flows_share_a_target(spark, tmp_path, rows):
    table = name("orders")
    spark.createDataFrame([(1, "t"), (2, "t")], "id int, src string").write.option(
        "path", str(tmp_path / "table")
    ).saveAsTable(table)
    write_csv(tmp_path / "files/a.csv", "id,src", "3,f")
    target, state = str(tmp_path / "union"), str(tmp_path / "state")

    def run():
        streams = {
            "table": readers.stream_table(spark, table),
            "files": readers.stream_files(spark, str(tmp_path / "files"), "id int, src string", "*.csv"),
        }
        flows.append_flows(target, streams, state)

    run()
    run()
    assert rows(flows.read_flows(spark, target)) == [(1, "t"), (2, "t"), (3, "f")]
    write_csv(tmp_path / "files/b.csv", "id,src", "4,f")
    writers.append_rows(spark, table, [(5, "t")])
    run()
    # A flow may join later.
    extra = readers.stream_files(spark, str(tmp_path / "files"), "id int, src string", "a.csv")
    flows.append_flows(target, {"again": extra}, state)
    got = flows.read_flows(spark, target, tagged=True)
    assert rows(got, "id", "flow") == [
        (1, "table"), (2, "table"), (3, "again"), (3, "files"), (4, "files"), (5, "table"),
    ]


FEED = [
    [(6, "base", "I", TS(2024, 1, 1)), (7, "other", "I", TS(2024, 1, 1)), (8, "gone", "I", TS(2024, 1, 1))],
    [(6, "new", "I", TS(2024, 1, 4)), (8, "gone", "D", TS(2024, 1, 5)), (9, "", "T", TS(2024, 1, 1, 12))],
    [(6, "late", "I", TS(2024, 1, 3)), (8, "too late", "I", TS(2024, 1, 4)), (7, "back", "I", TS(2024, 1, 2))],
]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_change_stream_equals_batch_in_any_order(order, spark, tmp_path, rows):
    every = spark.createDataFrame([r for part in FEED for r in part], SCHEMA)
    want1 = rows(cdc.scd1(every, ["k"], "seq", "act = 'D'", "act = 'T'"))
    want2 = rows(cdc.scd2(every, ["k"], "seq", ["act"]))
    src = str(tmp_path / "feed")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")

    def pump():
        for path, kind in ((one, 1), (two, 2)):
            stream = readers.stream_files(spark, src, SCHEMA, fmt="parquet")
            changes.apply_changes(
                stream, path, path + "-state", ["k"], "seq", kind, "act = 'T'" if kind == 1 else None
            ).awaitTermination()

    for step, i in enumerate(order):
        spark.createDataFrame(FEED[i], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        pump()
        if step == 1:
            changes.compact_changes(spark, one, ["k"], "seq", 1, "act = 'T'")
            changes.compact_changes(spark, two, ["k"], "seq", 2)
    pump()  # nothing new
    assert rows(changes.read_scd1(spark, one, ["k"], "seq", "act = 'D'", "act = 'T'")) == want1
    assert rows(changes.read_scd2(spark, two, ["k"], "seq", ["act"])) == want2
    last = changes.compact_changes(spark, one, ["k"], "seq", 1, "act = 'T'")
    assert last == changes.compact_changes(spark, one, ["k"], "seq", 1, "act = 'T'")
    assert rows(changes.read_scd1(spark, one, ["k"], "seq", "act = 'D'", "act = 'T'")) == want1


def test_layers_follow_their_inputs(spark, tmp_path, rows):
    shops, sales = str(tmp_path / "shops"), str(tmp_path / "sales")
    schema = name("layers")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/schema'")
    shop_schema = "shop int, town string, kind string, at timestamp_ntz"
    sale_schema = "sale int, sold_in int, colour string, price double"

    def add(path, schema_, data):
        spark.createDataFrame(data, schema_).coalesce(1).write.mode("append").parquet(path)

    def run():
        return medallion.run_layers(
            spark,
            medallion.LayerSpec(
                dimension=readers.stream_files(spark, shops, shop_schema, fmt="parquet"),
                facts={"till": readers.stream_files(spark, sales, sale_schema, fmt="parquet")},
                root=str(tmp_path / "root"),
                schema=schema,
                keys=["shop"],
                seq="at",
                on={"shop": "sold_in"},
                by=["town"],
                measures={"n": F.count("sale"), "income": F.sum("price")},
                delete_when="kind = 'gone'",
                except_cols=["kind", "at"],
                dimension_rules={"in a town": "length(town) > 0"},
                fact_rules={"paid": "price >= 1", "one colour": "colour not like '%,%'"},
                split_by="colour",
                split_values=["red", "blue"],
                names={"detail": "sales_in_towns"},
            ),
        )

    day = lambda d: TS(2024, 1, d)
    add(shops, shop_schema, [(1, "Ulm", "put", day(1)), (2, "Bonn", "put", day(1)), (3, None, "put", day(1))])
    add(sales, sale_schema, [(10, 1, "red", 5.0), (11, 1, "blue", 7.0), (12, 1, "red,blue", 9.0), (13, 2, None, 9.0)])
    tables = run()
    assert rows(tables["rollup"]) == [("Bonn", 0, None), ("Ulm", 2, 12.0)]
    assert rows(tables["rollup_red"]) == [("Ulm", 1, 5.0)]
    assert "loaded_at" in tables["detail"].columns

    add(shops, shop_schema, [(1, "Bonn", "put", day(3)), (2, "Bonn", "gone", day(4))])
    add(sales, sale_schema, [(14, 2, "red", 1.0)])
    tables = run()
    # A delete without a delete rule is a version of type 2, and closes type 1.
    assert rows(tables["now"], "shop") == [(1,)]
    assert rows(tables["rollup"]) == [("Bonn", 3, 13.0)]
    assert rows(spark.table(f"{schema}.rollup_blue")) == [("Bonn", 1, 7.0)]
    again = run()
    assert rows(again["rollup"]) == [("Bonn", 3, 13.0)]
    detail = spark.sql(f"DESCRIBE EXTENDED {schema}.sales_in_towns").collect()
    text = " ".join(f"{r[0]} {r[1]}" for r in detail)
    assert "layer=detail" in text and "open versions with their facts" in text


def test_comments_may_hold_quotes(spark):
    table = name("quoted")
    medallion.materialize(spark.range(1), table, properties={"it's": "o'clock"}, comment="it's \\ here")
    text = str(spark.sql(f"DESCRIBE EXTENDED {table}").collect())
    assert "it's=o'clock" in text
    spark.sql(f"DROP TABLE {table}")


def test_fan_out_binds_each_value(spark, rows):
    df = spark.createDataFrame([("O", 1), ("F", 2), ("F", 3)], "s string, v int")
    built = medallion.fan_out(df, "s", "O,F", lambda d: d.groupBy().sum("v"))
    assert {k: rows(v) for k, v in built.items()} == {"O": [(1,)], "F": [(5,)]}


def test_jobs(spark, tmp_path):
    from tarnwork.plans import jobs

    write_csv(tmp_path / "emp/a.csv", "id,department", "1,Sales", "2,SALES", "3,IT")
    src = str(tmp_path / "emp")
    assert jobs.copy_csv(spark, src, str(tmp_path / "copy")) == 3
    assert readers.scan_path_sql(spark, str(tmp_path / "copy")).dtypes[0] == ("id", "int")
    prefix = name("dept") + "_"
    assert jobs.write_department(spark, src, "sales", prefix, str(tmp_path / "dept")) == 2
    assert readers.scan_table(spark, prefix + "sales").count() == 2
    assert jobs.write_department(spark, src, "law", prefix) == 0
    assert jobs.run_day(spark, "2024-05-03T10:00:00") == "Fri"


def test_rule_counts_while_writing(spark, tmp_path):
    from pyspark.sql import Observation

    from tarnwork.operators import quality

    rules = {"positive": "v > 0", "known": "t is not null"}
    df = spark.createDataFrame([(1, "a"), (-1, None), (None, "b")], "v int, t string")
    seen = Observation()
    df.observe(seen, *quality.rule_counts(rules)).write.parquet(str(tmp_path / "o"))
    assert seen.get == {"positive": 2, "known": 1}


def test_shared_folder_is_read_from_the_session(spark):
    from tarnwork.sources import storage

    shared = storage.shared_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared == (named.rstrip("/") if named else spark.sparkContext.getCheckpointDir())
    one, two = storage.scratch_dir(spark, "x"), storage.scratch_dir(spark, "x")
    assert one != two and one.startswith(shared)


# -- names of storage folders as columns -------------------------------------------------


def test_columns_named_like_folders_are_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", "f", "u")], "id int, batch string, flow string, upto string")
    src = str(tmp_path / "src")
    df.write.parquet(src)
    stream = lambda: spark.readStream.schema(df.schema).parquet(src)
    target = str(tmp_path / "t")
    flows.append_flows(target, {"x": stream()}, str(tmp_path / "c"))
    assert flows.read_flows(spark, target).select(*df.columns).collect() == df.collect()
    with pytest.raises(ValueError):
        flows.read_flows(spark, target, tagged=True)
    path = str(tmp_path / "log")
    changes.apply_changes(stream(), path, str(tmp_path / "c2"), ["id"], "upto", 1).awaitTermination()
    changes.compact_changes(spark, path, ["id"], "upto", 1)
    assert changes.read_scd1(spark, path, ["id"], "upto").select(*df.columns).collect() == df.collect()


def test_stores_before_anything_arrived(spark, tmp_path):
    path = str(tmp_path / "none")
    assert flows.read_flows(spark, path, schema="id int").count() == 0
    assert changes.read_scd1(spark, path, ["id"], "n", schema="id int, n int").count() == 0


def test_paths_with_their_file_system(spark):
    from tarnwork.sources.storage import qualified

    assert qualified(spark, "/a/b") == "file:/a/b" == qualified(spark, "file:/a/b")


def test_half_written_batches_of_a_flow_are_not_seen(spark, tmp_path, rows):
    src, target = str(tmp_path / "src"), tmp_path / "t"
    spark.range(3).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)
    flows.append_flows(str(target), {"x": stream}, str(tmp_path / "c"))
    spark.range(5).write.parquet(str(target / "flow=x" / "batch=7"))  # its writer died before the entry
    spark.range(5).write.parquet(str(target / "flow=y" / "batch=0"))
    assert rows(flows.read_flows(spark, str(target))) == [(0,), (1,), (2,)]
    assert flows.committed_batches(spark, str(target)) == [f"{target}/flow=x/batch=0"]
    with pytest.raises(FileNotFoundError):
        flows.read_flows(spark, str(tmp_path / "none"))


def test_a_late_change_rewrites_one_bucket(spark, tmp_path, rows):
    feed, path, schema = str(tmp_path / "feed"), tmp_path / "store", "k int, v string, n int"

    def bring(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        changes.apply_changes(stream, str(path), str(tmp_path / "c"), ["k"], "n", 2, buckets=8).awaitTermination()
        return changes.compact_changes(spark, str(path), ["k"], "n", 2)

    def files():
        upto, base = changes._manifest(spark, str(path))
        found = {b: sorted(f.name for f in (path / f"base/upto={u}/__bucket={b}").glob("*.parquet")) for b, u in base.items()}
        assert all(found.values())
        return found

    every = [(k, "first", 5) for k in range(100)]
    assert bring(every) == 0
    before = files()
    assert len(before) == 8
    late = [(17, "late", 3), (17, "later", 9)]
    assert bring(late) == 1
    after = files()
    changed = [b for b in before if before[b] != after[b]]
    bucket = spark.createDataFrame([(17,)], "k int").select(changes._bucket(["k"], 8)).first()[0]
    assert changed == [bucket]
    want = rows(cdc.scd2(spark.createDataFrame(every + late, schema), ["k"], "n"))
    assert rows(changes.read_scd2(spark, str(path), ["k"], "n")) == want
    assert changes.compact_changes(spark, str(path), ["k"], "n", 2) == 1  # nothing new
    assert changes.remove_compacted(spark, str(path)) == 4  # two batches, a manifest, a bucket
    assert rows(changes.read_scd2(spark, str(path), ["k"], "n")) == want
    assert files() == after


def test_a_bucket_that_a_truncate_empties(spark, tmp_path, rows):
    feed, path, schema = str(tmp_path / "feed"), str(tmp_path / "store"), "k int, act string, n int"
    steps = [[(k, "I", k % 3) for k in range(20)], [(None, "T", 2)], [(k, "I", 1) for k in range(20)], [(3, "I", 7)]]
    for data in steps:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        changes.apply_changes(stream, path, str(tmp_path / "c"), ["k"], "n", 1, "act = 'T'", 4).awaitTermination()
        changes.compact_changes(spark, path, ["k"], "n", 1, "act = 'T'")
        changes.remove_compacted(spark, path)
    every = spark.createDataFrame([r for data in steps for r in data], schema)
    want = rows(cdc.scd1(every, ["k"], "n", None, "act = 'T'"))
    assert rows(changes.read_scd1(spark, path, ["k"], "n", None, "act = 'T'")) == want


def test_a_batch_without_marker_is_an_error(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(1).selectExpr("id", "id AS n").write.parquet(f"{path}/log/batch=0")
    (tmp_path / "log" / "log" / "batch=0" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match="marker"):
        changes.read_scd1(spark, path, ["id"], "n")


def test_headers_are_read_where_the_files_are(spark, tmp_path):
    write_csv(tmp_path / "in/a.csv", "id,v", "1,x")
    write_csv(tmp_path / "in/b.csv", "v,id", "y,2")
    write_csv(tmp_path / "in/c d%20e.csv", "id,v")
    (tmp_path / "in/empty.csv").write_text("")
    (tmp_path / "in/wide.csv").write_text(",".join(f"column_{i}" for i in range(4000)) + "\r\n")
    with gzip.open(tmp_path / "in/z.csv.gz", "wt") as out:
        out.write("id,v\n3,z\n")
    files = spark.createDataFrame([(f"file:{p}",) for p in (tmp_path / "in").iterdir()], "path string")
    groups = incremental._by_header(spark, files)
    short = {h: [p.rsplit("/", 1)[1] for p in paths] for h, paths in groups.items() if len(h) < 10}
    assert short == {"id,v": ["a.csv", "c d%20e.csv", "z.csv.gz"], "v,id": ["b.csv"]}
    assert len(groups) == 3
    rows = incremental._read_csv_by_header(spark, files.where("path NOT LIKE '%wide%' AND path NOT LIKE '%/c d%'"), {})
    assert sorted((r["id"], r["v"]) for r in rows.collect()) == [("1", "x"), ("2", "y"), ("3", "z")]


def test_layers_fold_their_stores(spark, tmp_path, rows):
    schema = name("folded")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/schema'")
    dim, fact = str(tmp_path / "dim"), str(tmp_path / "fact")
    spark.createDataFrame([(1, 2.0)], "of int, v double").write.parquet(fact)
    for n in range(4):
        spark.createDataFrame([(1, f"v{n}", n), (n, "w", 10 + n)], "k int, t string, n int").coalesce(1).write.mode("append").parquet(dim)
        built = medallion.run_layers(
            spark,
            medallion.LayerSpec(
                dimension=readers.stream_files(spark, dim, "k int, t string, n int", fmt="parquet"),
                facts={"f": readers.stream_files(spark, fact, "of int, v double", fmt="parquet")},
                root=str(tmp_path / "root"),
                schema=schema,
                keys=["k"],
                seq="n",
                on={"k": "of"},
                by=["t"],
                measures={"worth": F.sum("v")},
                compact_after=1,
            ),
        )
    assert len(changes.new_batches(spark, str(tmp_path / "root/versions"))) <= 1
    every = spark.read.parquet(dim)
    assert rows(built["versions"]) == rows(cdc.scd2(every, ["k"], "n"))
    assert rows(built["now"]) == rows(cdc.scd1(every, ["k"], "n"))
