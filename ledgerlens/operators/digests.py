"""EXT-7 / CHK-3: two runs compared by digests.

A table is cut by date and by a hash of its key into buckets; a bucket's digest is its
number of rows and an order-free hash of them, one aggregate that combines before its
shuffle. Equal digests mean equal rows; only rows of unequal buckets are compared one by
one. Folders that two states of a table share are equal as they are and are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.extensions import run_diff
from ledgerlens.plans.warehouse import Warehouse

BUCKETS = 256


def _placed(df: DataFrame, keys: list[str], date_col: str | None, buckets: int) -> DataFrame:
    date = F.coalesce(F.col(date_col).cast("string"), F.lit("")) if date_col else F.lit("")
    return df.withColumns({"_date": date, "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")})


def digest_tree(df: DataFrame, keys: list[str], date_col: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``(_date, _bucket, rows, total, mixed)``: a leaf per date and bucket. A row counts by
    two hashes of its whole content, one added up and one combined bit by bit."""
    cols = sorted(df.columns)
    row = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cols])
    return _placed(df, keys, date_col, buckets).withColumn("_row", row).groupBy("_date", "_bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_row").cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64("_row", F.lit("mixed"))).alias("mixed"))


def unequal_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(_date, _bucket)`` of the leaves that two digest trees do not share."""
    return a.unionByName(b).groupBy("_date", "_bucket").agg(
        F.count(F.lit(1)).alias("n"), *[F.countDistinct(c).alias(c) for c in ("rows", "total", "mixed")]).where(
        "n = 1 or rows + total + mixed > 3").select("_date", "_bucket")


def tree_diff(a: DataFrame, b: DataFrame, keys: list[str], date_col: str | None = None,
              buckets: int = BUCKETS) -> DataFrame:
    """Rows only in one of two tables, with their ``side`` (``only_a``, ``only_b``)."""
    leaves = unequal_leaves(digest_tree(a, keys, date_col, buckets), digest_tree(b, keys, date_col, buckets)).collect()
    if not leaves:  # at most a row per date and bucket
        return a.limit(0).withColumn("side", F.lit(""))
    found = a.sparkSession.createDataFrame(leaves, "_date string, _bucket int")
    dates = [r[0] for r in leaves]

    def inside(df: DataFrame) -> DataFrame:
        if date_col and "" not in dates:
            df = df.where(F.col(date_col).cast("string").isin(sorted(set(dates))))
        return _placed(df, keys, date_col, buckets).join(F.broadcast(found), ["_date", "_bucket"], "left_semi").select(*a.columns)
    return run_diff(inside(a), inside(b))


def compare_runs(warehouse: Warehouse, run_a: str, run_b: str, tables: dict[str, tuple[str, ...]],
                 buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """Per table (name -> key) the rows in which two published runs differ."""
    one, two = warehouse.at(run_a), warehouse.at(run_b)
    out = {}
    for table, keys in tables.items():
        a, b = one.unshared(table, two), two.unshared(table, one)
        date = "as_of_date" if "as_of_date" in a.columns else None
        out[table] = tree_diff(a, b, list(keys), date, buckets)
    return out
