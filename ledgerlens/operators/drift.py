"""EXT-12: a change of meaning or population that leaves the schema as it was.

Two runs are compared by sketches of fixed size: per column a histogram of 256 hashed
values (texts, dates, flags) or of the first digits (numbers), one count for nulls. Sketches
are counts, so they add up over parts of a run and can be kept instead of it. A sketch reads
its table once and shuffles what the tasks have counted, a few hundred rows a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
MEANING = 0.10      # share of rows that moved to other buckets, above chance
POPULATION = 0.20   # share by which the number of rows rose or fell


def _bucket(name: str, data_type: T.DataType) -> Column:
    """The bucket of a value: two hex digits of its hash; of a number its sign, the digits
    before the point and the first of them."""
    c = F.col(name)
    if isinstance(data_type, T.NumericType):
        digits = F.floor(F.abs(c)).cast("string")
        bucket = F.concat(F.when(c < 0, "-").otherwise(""), F.length(digits).cast("string"), F.lit(":"), digits.substr(1, 1))
    else:
        bucket = F.md5(c.cast("string")).substr(1, 2)
    return F.coalesce(bucket, F.lit("null"))


def content_sketch(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, column_name, bucket, rows)`` of some columns, for each value of ``by`` (a run,
    a date) apart. A table without rows has an empty sketch; columns are told by name."""
    types = {f.name: f.dataType for f in df.schema.fields}
    told = F.array(*[F.struct(F.lit(c).alias("column_name"), _bucket(c, types[c]).alias("bucket")) for c in columns])
    return (df.select(*by, F.explode(told).alias("s")).groupBy(*by, "s.column_name", "s.bucket")
            .agg(F.count(F.lit(1)).alias("rows")))


def classify_content_change(old: DataFrame, new: DataFrame, by: tuple[str, ...] = (),
                            meaning: float = MEANING, population: float = POPULATION) -> DataFrame:
    """One row per column of two sketches: rows before and after, the share of rows whose
    bucket changed (half the sum of differences of shares) and what of it chance explains.

    ``POPULATION`` where the number of rows changed by more than ``population``, ``MEANING``
    where more than ``meaning`` beyond chance moved, both are breaking; ``ADDED`` and
    ``REMOVED`` columns (or runs) as for schemas; else ``NONE``.
    """
    key = [*by, "column_name"]
    zero = F.lit(0).cast("long")
    sides = (old.select(*key, "bucket", F.col("rows").alias("a"), zero.alias("b"))
             .unionByName(new.select(*key, "bucket", zero.alias("a"), F.col("rows").alias("b")))
             .groupBy(*key, "bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    totals = sides.groupBy(*key).agg(F.sum("a").alias("rows_before"), F.sum("b").alias("rows_after"),
                                     F.count(F.lit(1)).alias("buckets"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    apart = (sides.join(totals, key).groupBy(*key, "rows_before", "rows_after", "buckets")
             .agg(F.sum(F.abs(big("a") * big("rows_after") - big("b") * big("rows_before"))).alias("apart")))
    n, m = F.col("rows_before").cast("double"), F.col("rows_after").cast("double")
    both = (F.col("rows_before") > 0) & (F.col("rows_after") > 0)
    moved = F.when(both, F.col("apart").cast("double") / (n * m * 2))
    chance = F.when(both & (F.col("buckets") > 1), F.sqrt(F.col("buckets").cast("double") * (F.lit(1.0) / n + F.lit(1.0) / m)) / 2).when(
        both, F.lit(0.0))
    change = (F.when(F.col("rows_before") == 0, "ADDED").when(F.col("rows_after") == 0, "REMOVED")
              .when(F.abs(m - n) > n * population, "POPULATION").when(moved - chance > meaning, "MEANING").otherwise("NONE"))
    return apart.select(
        *key, "rows_before", "rows_after", F.round(moved, 4).alias("moved"), F.round(chance, 4).alias("chance"),
        change.alias("change"),
        F.when(change == "NONE", "none").when(change == "ADDED", "additive").otherwise("breaking").alias("classification"))
