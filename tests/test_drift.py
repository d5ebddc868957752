"""EXT-12 without a change of schema: recodes and cuts are found, a plain new day is not."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.drift import classify_content_change, content_sketch


@pytest.fixture(scope="module")
def days(spark):
    def day(seed, n=20_000):
        return spark.range(n).select(
            F.element_at(F.array(*[F.lit(s) for s in ("BANK", "CORP", "CORP", "HOUSEHOLD", None)]),
                         (F.rand(seed) * 5).cast("int") + 1).alias("sector"),
            (F.exp(F.randn(seed + 1) + 8)).cast("decimal(20,2)").alias("amount"),
            F.concat(F.lit(f"{seed}-"), F.col("id").cast("string")).alias("key"), F.lit("EUR").alias("currency"))
    return day


def _changes(old, new):
    columns = [c for c in old.columns if c in new.columns]
    found = classify_content_change(content_sketch(old, columns), content_sketch(new, columns)).collect()
    assert {r.column_name for r in found} == set(columns)
    return {r.column_name: r.change for r in found if r.change != "NONE"}


def test_a_plain_new_day_is_no_change(days):
    assert _changes(days(1), days(50)) == {}
    assert _changes(days(1, 300), days(50, 310)) == {}      # few rows: chance explains the difference


def test_recode_scale_and_nulls_are_changes_of_meaning(days):
    old, new = days(1), days(50)
    assert _changes(old, new.withColumn("sector", F.when(F.col("sector") == "CORP", "S11").otherwise(F.col("sector")))) == {"sector": "MEANING"}
    assert _changes(old, new.withColumn("amount", F.col("amount") / 1000)) == {"amount": "MEANING"}   # thousands instead of units
    assert _changes(old, new.withColumn("amount", -F.col("amount"))) == {"amount": "MEANING"}
    assert _changes(old, new.withColumn("currency", F.lit(None).cast("string"))) == {"currency": "MEANING"}


def test_a_cut_population_is_found_whatever_the_shares(days):
    old = days(1)
    assert set(_changes(old, days(50, 14_000)).values()) == {"POPULATION"}
    assert set(_changes(old, old.where("false")).values()) == {"REMOVED"}
    assert set(_changes(old.where("false"), old).values()) == {"ADDED"}


def test_sketches_add_up(days):
    df = days(1)
    whole = content_sketch(df, ["sector", "amount"])
    parts = content_sketch(df.where("amount < 2000"), ["sector", "amount"]).unionByName(
        content_sketch(df.where("not amount < 2000"), ["sector", "amount"])).groupBy("column_name", "bucket").agg(F.sum("rows").alias("rows"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
