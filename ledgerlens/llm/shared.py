"""Helpers the operators share: tables, stored stages, batches, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

#: Bytes of text that a Python task holds decoded at a time.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a session on one machine (tests) without that setting has a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a lost
    executor costs the tasks that read its share, never the work before."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of this run that nothing reads any more; a missing one is fine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``limit`` bytes of ``column``;
    a single longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.frombuffer(pa.compute.fill_null(pa.compute.binary_length(col), 0)
                              .cast(pa.int64()).buffers()[1], np.int64)[:batch.num_rows]
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The ranges ``flat[starts[i]:starts[i] + lens[i]]``, one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - (ends - lens), lens)
    at += np.arange(total)
    return flat[at]


#: Tasks whose partial counts are added up in one place.
FAN_IN = 64


def added_up(rows: DataFrame, key: str, dtype: str) -> DataFrame:
    """``(key, counts)``: the arrays in ``counts`` (binary) of each key, added up.

    ``rows`` has the columns ``key, part, counts``, a row for each key and task ``part``,
    and is a written table. They are added in rounds of ``FAN_IN`` tasks: neither a
    frequent key nor many tasks meet in one place."""
    def add(some: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1, dtype)
        for x in some["counts"]:
            total = total + np.frombuffer(x, dtype)
        return pd.DataFrame({key: some[key][:1], "part": some["part"][:1] // FAN_IN, "counts": [total.tobytes()]})

    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        rows = rows.groupBy(key, F.expr(f"part div {FAN_IN}")).applyInPandas(add, rows.schema)
        parts = -(-parts // FAN_IN)
        if parts == 1:
            return rows.select(key, "counts")


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: ``(id, component)`` with the smallest id of each.

    ``vertices(id)`` and ``edges(a, b)`` of long ids; an edge's ends need not be among
    the vertices. Large-star / small-star rounds over the edge table: every round is
    two aggregations and the table never grows beyond the edges, so a star with many
    leaves or a long chain costs no more than its edges; the rounds are logarithmic in
    the longest chain. Each round is written to the shared folder.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, larger: bool) -> DataFrame:
        around = both(e) if larger else e
        least = around.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        out = around.join(least, "a")
        if larger:
            return out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))).where("a > b")

    tip = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    edges = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    was, now = None, tip(edges)
    while was != now:
        edges = stored(star(star(edges, True).distinct(), False).distinct(), "edges")
        was, now = now, tip(edges)
    return vertices.join(edges.select(F.col("a").alias("id"), F.col("b").alias("component")),
                         "id", "left").select("id", F.coalesce("component", "id").alias("component"))
