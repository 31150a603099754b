"""Layered tables of any dimension feed and any fact streams, described by a spec."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.operators.aggregate import group
from tarnwork.operators.joins import join_current
from tarnwork.operators.quality import expect_all_or_drop
from tarnwork.sources.writers import save_table, sql_text
from tarnwork.streaming.changes import apply_changes, compact_changes, new_batches, read_scd1, read_scd2
from tarnwork.streaming.flows import append_flows, read_flows


def materialize(
    df: DataFrame,
    name: str,
    path: str | None = None,
    properties: Mapping[str, str] | None = None,
    comment: str | None = None,
) -> DataFrame:
    """Recompute a table; tag it with properties and a comment."""
    spark = df.sparkSession
    save_table(df, name, path=path)

    if properties:
        pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {sql_text(comment)}")
    return spark.table(name)


def view(name: str, df: DataFrame) -> DataFrame:
    """A named intermediate result."""
    df.createOrReplaceTempView(name)
    return df


def enrich(
    dim: DataFrame, fact: DataFrame, on: Mapping[str, str], stamp: str | None = None
) -> DataFrame:
    """Open dimension versions with their facts; ``stamp`` names a column for the time
    of loading."""
    joined = join_current(dim, fact, on)
    return joined.withColumn(stamp, F.current_timestamp()) if stamp else joined


def fan_out(
    df: DataFrame,
    col: str,
    values: str | Sequence[str],
    build: Callable[[DataFrame], DataFrame],
) -> dict[str, DataFrame]:
    """One result per value of a comma-separated list."""
    wanted = values.split(",") if isinstance(values, str) else list(values)
    return {v: build(df.where(F.col(col) == v)) for v in wanted}


@dataclass
class LayerSpec:
    """What one flow reads, how it joins and what it counts.

    ``dimension`` is a stream of changes, ``facts`` are streams by flow name, which are all
    appended to one store. ``on`` maps a dimension column to a fact column. ``measures`` are
    the aggregates of the rollup, per ``by``; with ``split_by`` there is a rollup for each of
    ``split_values`` as well. ``names`` renames tables: ``now``, ``versions``, ``facts``,
    ``detail``, ``rollup``, ``by_value`` and ``rollup_<value>`` are the defaults.
    """

    dimension: DataFrame
    facts: Mapping[str, DataFrame]
    root: str
    schema: str
    keys: Sequence[str]
    seq: str
    on: Mapping[str, str]
    by: Sequence[str]
    measures: Mapping[str, Column]
    delete_when: str | None = None
    truncate_when: str | None = None
    except_cols: Sequence[str] = ()
    dimension_rules: Mapping[str, str] = field(default_factory=dict)
    fact_rules: Mapping[str, str] = field(default_factory=dict)
    split_by: str | None = None
    split_values: Sequence[str] = ()
    stamp: str | None = "loaded_at"
    names: Mapping[str, str] = field(default_factory=dict)
    #: Batches that a change store may hold before they are folded into its base.
    compact_after: int = 8

    def name(self, table: str) -> str:
        return self.names.get(table, table)


def run_layers(spark: SparkSession, spec: LayerSpec) -> dict[str, DataFrame]:
    """Bring all tables up to date with what the streams have available, in order: the
    dimension, the facts, the detail, the rollups. Safe to repeat; only new input is read.
    The result has the tables by their default names."""
    store = lambda part: f"{spec.root}/{part}"
    state = store("_checkpoints")
    changes = expect_all_or_drop(spec.dimension, spec.dimension_rules)
    facts = {n: expect_all_or_drop(s, spec.fact_rules) for n, s in spec.facts.items()}

    running = [
        apply_changes(
            changes,
            store(part),
            f"{state}/{part}",
            spec.keys,
            spec.seq,
            kind,
            spec.truncate_when if kind == 1 else None,
        )
        for part, kind in (("now", 1), ("versions", 2))
    ]
    append_flows(store("facts"), facts, state)
    for stream in running:
        stream.awaitTermination()
    for part, kind, truncate in (("now", 1, spec.truncate_when), ("versions", 2, None)):
        if len(new_batches(spark, store(part))) > spec.compact_after:
            compact_changes(spark, store(part), spec.keys, spec.seq, kind, truncate)

    built = {
        "now": read_scd1(
            spark, store("now"), spec.keys, spec.seq, spec.delete_when, spec.truncate_when
        ),
        "versions": read_scd2(spark, store("versions"), spec.keys, spec.seq, spec.except_cols),
        "facts": read_flows(spark, store("facts")),
    }
    for table, df in built.items():
        view(spec.name(table), df)

    def save(df: DataFrame, table: str, layer: str, comment: str) -> DataFrame:
        name = spec.name(table)
        path = f"{store('tables')}/{name}"
        built[table] = materialize(df, f"{spec.schema}.{name}", path, {"layer": layer}, comment)
        return built[table]

    detail = enrich(built["versions"], built["facts"], spec.on, spec.stamp)
    detail = save(detail, "detail", "detail", "open versions with their facts")
    save(group(detail, spec.by, spec.measures), "rollup", "rollup", f"by {', '.join(spec.by)}")
    if spec.split_by:
        # One pass over the detail serves every value; the tables are cut from its
        # result, which has one row per value and group.
        wanted = detail.where(F.col(spec.split_by).isin(list(spec.split_values)))
        split = group(wanted, [spec.split_by, *spec.by], spec.measures)
        split = save(split, "by_value", "rollup", f"by {spec.split_by}")
        parts = fan_out(split, spec.split_by, spec.split_values, lambda df: df.drop(spec.split_by))
        for value, df in parts.items():
            save(df, f"rollup_{value}", "rollup", f"{spec.split_by} {value}")
    return built
