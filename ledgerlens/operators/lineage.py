"""LIN-1..6: querying column-level lineage captured as data.

Lineage rows: ``(rule_id, target_layer, target_table, target_column,
source_layer, source_table, source_column, transformation, regulatory_facing)``.
Targets are bare table names; sources may be namespace-qualified
(``canon.position``), so joins strip the namespace first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import reached


def bare_table(col) -> "F.Column":
    """``canon.position`` -> ``position``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"^.*\.", "")


def _node(table: str, column: str) -> Column:
    return F.struct(F.col(table).alias("t"), F.col(column).alias("c"))


def column_edges(lineage: DataFrame) -> DataFrame:
    """Distinct steps ``a -> b`` from a target column to a column it is made of, where that
    is a target itself. A source without a column name (a constant, a count) stands for
    every column of its table."""
    rows = lineage.where(F.col("source_layer") != "SOURCE").select(
        _node("target_table", "target_column").alias("a"),
        bare_table("source_table").alias("t"), F.coalesce("source_column", F.lit("")).alias("c"))
    targets = lineage.select(F.col("target_table").alias("t"), F.col("target_column").alias("own")).distinct()
    return (rows.join(targets, "t").where((F.col("c") == "") | (F.col("c") == F.col("own")))
            .select("a", F.struct("t", F.col("own").alias("c")).alias("b")).distinct())


def trace(spark: SparkSession, lineage: DataFrame, table: str,
          column: str | None = None) -> DataFrame:
    """LIN-1: walk a reported column (or every column of a table) back to sources.

    Every column on the way is visited once, at its least distance, so the walk ends on
    cycles, is complete however long the chain, and grows with the columns, not with the
    paths between them. Rows are unique per (target, source); ``hop`` 1 is the start.
    """
    rows = lineage.withColumn("node", _node("target_table", "target_column"))
    start = rows.where(F.col("target_table") == table)
    if column is not None:
        start = start.where(F.col("target_column") == column)
    return (rows.join(reached(column_edges(lineage), start), "node")
            .groupBy((F.col("steps") + 1).alias("hop"), "target_table", "target_column",
                     "source_table", "source_column")
            .agg(F.min("source_layer").alias("source_layer"), F.min("transformation").alias("transformation"))
            .select("hop", "target_table", "target_column", "source_layer", "source_table",
                    "source_column", "transformation"))


def impacted(lineage: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """Forward lineage: every target column that ``table`` (or one column of it) flows
    into, with the least number of hops."""
    direct = lineage.where(bare_table("source_table") == table)
    if column is not None:
        direct = direct.where((F.col("source_column") == column) | (F.col("source_column") == ""))
    down = column_edges(lineage).select(F.col("b").alias("a"), F.col("a").alias("b"))
    found = reached(down, direct.select(_node("target_table", "target_column").alias("node")))
    layers = lineage.groupBy(_node("target_table", "target_column").alias("node")).agg(
        F.min("target_layer").alias("target_layer"))
    return found.join(layers, "node").select(
        "target_layer", F.col("node.t").alias("target_table"), F.col("node.c").alias("target_column"),
        (F.col("steps") + 1).alias("hop"))


def trace_summary(traced: DataFrame) -> DataFrame:
    """LIN-3: rows, depth, and the distinct SOURCE tables the trace lands on."""
    return traced.agg(
        F.count(F.lit(1)).alias("trace_rows"),
        F.max("hop").alias("max_hop"),
        F.array_sort(F.collect_set(F.when(F.col("source_layer") == "SOURCE",
                                          F.col("source_table")))).alias("landing_sources"))


def unmapped_columns(catalog: DataFrame, lineage: DataFrame, table: str | None = None,
                     layer: str | None = None) -> DataFrame:
    """LIN-2: catalog columns with no lineage row targeting them."""
    cols = catalog
    if layer is not None:
        cols = cols.where(F.col("layer") == layer)
    if table is not None:
        cols = cols.where(F.col("table_name") == table)
    mapped = lineage.select(F.col("target_table").alias("table_name"),
                            F.col("target_column").alias("column_name")).distinct()
    return cols.join(mapped, ["table_name", "column_name"], "left_anti")


def passthrough_columns(lineage: DataFrame) -> DataFrame:
    """LIN-6: (table, column) pairs with an equally named source column."""
    return (lineage.where(F.col("target_column") == F.col("source_column"))
            .select("target_table", "target_column").distinct())


def tables_reaching_source(lineage: DataFrame) -> DataFrame:
    """LIN-5: ``(table_name, depth)`` of the tables whose lineage reaches a SOURCE-layer
    table, with the least number of steps. Walks from the sources up; no depth limit."""
    edges = lineage.select(
        F.concat_ws(".", F.when(F.col("source_layer") == "SOURCE", F.lit("SOURCE")),
                    bare_table("source_table")).alias("a"),
        F.col("target_table").alias("b"), "source_layer").distinct()
    sources = edges.where(F.col("source_layer") == "SOURCE").select(F.col("a").alias("node"))
    return reached(edges.select("a", "b"), sources).where("steps > 0").select(
        F.col("node").alias("table_name"), F.col("steps").alias("depth"))


def columns_reaching_source(lineage: DataFrame) -> DataFrame:
    """LIN-4: (table, column) pairs whose lineage reaches a source system.

    A column reaches one if a row of it is a SOURCE row, or if the table it is made of
    reaches one: constants and aggregates have no single source column, so the chain is
    followed at table level, which covers the named columns too.
    """
    tables = tables_reaching_source(lineage).select(F.col("table_name").alias("source_bare"))
    rows = lineage.select("target_table", "target_column", "source_layer",
                          bare_table("source_table").alias("source_bare"))
    direct = rows.where(F.col("source_layer") == "SOURCE")
    via_table = rows.join(tables, "source_bare", "left_semi")
    return direct.unionByName(via_table).select("target_table", "target_column").distinct()
