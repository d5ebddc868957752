"""ANL-1..8: the analysis queries over the built views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Measure labels and netting treatment labels.
MEASURE_FIN_ASSETS = "Finance: derivative assets"
MEASURE_FIN_LIABILITIES = "Finance: derivative liabilities"
MEASURE_RISK_GROSS = "Risk: gross replacement cost"
MEASURE_RISK_EAD = "Risk: exposure at default (illustrative)"
TREATMENT_NETTED = "Enforceable agreement"
TREATMENT_GROSS = "No enforceable netting"


def _round0(c):
    return F.round(c, 0).cast("decimal(38,0)")


def four_measures(fin_detail: DataFrame, sets: DataFrame) -> DataFrame:
    """ANL-1: the same book through two lenses, four rounded totals.

    One aggregate pass over each input (conditional sums), then the two
    single-row results are unpivoted into four labelled rows.
    """
    fin = fin_detail.agg(
        F.sum(F.when(F.col("product_family") == "DERIVATIVE", F.col("asset_carrying_amount")))
         .cast("decimal(38,2)").alias("a"),
        F.sum("liability_fair_value").cast("decimal(38,2)").alias("b"))
    risk = sets.agg(F.sum("gross_replacement_cost").cast("decimal(38,6)").alias("a"),
                    F.sum("exposure_at_default").cast("decimal(38,6)").alias("b"))

    def unpivot(df: DataFrame, label_a: str, label_b: str) -> DataFrame:
        return df.select(F.explode(F.array(
            F.struct(F.lit(label_a).alias("measure"), _round0(F.col("a")).alias("amount")),
            F.struct(F.lit(label_b).alias("measure"), _round0(F.col("b")).alias("amount")),
        )).alias("m")).select("m.measure", "m.amount")

    return (unpivot(fin, MEASURE_FIN_ASSETS, MEASURE_FIN_LIABILITIES)
            .unionByName(unpivot(risk, MEASURE_RISK_GROSS, MEASURE_RISK_EAD)))


def population_differences(rec_population: DataFrame) -> DataFrame:
    """ANL-2: reasons by count, amounts rounded."""
    return (rec_population
            .select("difference_reason", "trade_count",
                    _round0(F.col("finance_asset_amount")).alias("finance_assets"),
                    _round0(F.col("risk_replacement_cost")).alias("risk_rc"))
            .orderBy(F.desc("trade_count"), F.asc("difference_reason")))


def netting_benefit(rec_netting: DataFrame) -> DataFrame:
    """ANL-3: netting benefit with a labelled treatment."""
    return rec_netting.select(
        F.when(F.col("netting_eligible"), F.lit(TREATMENT_NETTED))
         .otherwise(F.lit(TREATMENT_GROSS)).alias("treatment"),
        "netting_sets",
        _round0(F.col("gross_replacement_cost")).alias("gross_rc"),
        _round0(F.col("netted_replacement_cost")).alias("netted_rc"),
        _round0(F.col("collateral_recognised")).alias("collateral"),
        _round0(F.col("exposure_at_default")).alias("ead"))


def top_disagreements(disagreement: DataFrame, k: int = 8) -> DataFrame:
    """ANL-4: the k most material sector disagreements (ties broken by party key)."""
    return (disagreement
            .orderBy(F.desc("total_carrying_amount"), F.asc("party_key"))
            .limit(k)
            .select("party_key", "legal_name", "accounting_sector", "prudential_sector",
                    "arrangement_count",
                    _round0(F.col("total_carrying_amount")).alias("carrying_amount")))


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """ANL-4 / ANL-7 / ANL-8 totals: one row with the row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def hierarchy_divergence(hierarchy: DataFrame, party: DataFrame, as_of: str) -> DataFrame:
    """ANL-7: parties whose legal parent is not their risk-group parent.

    Equi-join on (child, date) with the unequal-parent residual; parent names
    looked up on the party table.
    """
    d = F.lit(as_of).cast("date")
    legal = (hierarchy.where((F.col("hierarchy_type") == "LEGAL_OWNERSHIP") &
                             (F.col("as_of_date") == d))
             .select(F.col("child_party_key").alias("party"), "as_of_date",
                     F.col("parent_party_key").alias("legal_parent_key")))
    rsk = (hierarchy.where(F.col("hierarchy_type") == "RISK_GROUP")
           .select(F.col("child_party_key").alias("party"), "as_of_date",
                   F.col("parent_party_key").alias("risk_parent_key")))
    names = party.select("party_key", "as_of_date", "legal_name")
    lp = names.select(F.col("party_key").alias("legal_parent_key"), "as_of_date",
                      F.col("legal_name").alias("legal_parent"))
    rp = names.select(F.col("party_key").alias("risk_parent_key"), "as_of_date",
                      F.col("legal_name").alias("risk_group_parent"))
    return (legal.join(rsk, ["party", "as_of_date"])
            .where(F.col("legal_parent_key") != F.col("risk_parent_key"))
            .join(lp, ["legal_parent_key", "as_of_date"], "left")
            .join(rp, ["risk_parent_key", "as_of_date"], "left")
            .select("party", "legal_parent", "risk_group_parent"))
