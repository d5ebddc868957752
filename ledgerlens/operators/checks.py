"""CHK-*: data-integrity checks as reusable operators.

Each check is a row ``(check_id, description, violations)``: a count of offending rows,
or 1 where something that has to be there is not; zero when the check holds. An area
joins its detail with what the checks need once, counts everything in one aggregate, and
unpivots that row, so its inputs are read and shuffled once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.digests import compare_runs
from ledgerlens.operators.extensions import run_diff
from ledgerlens.operators.finance import (SECTOR_ACCOUNTING, SECTOR_PRUDENTIAL,
                                          inception_dates)
from ledgerlens.operators.lineage import trace, unmapped_columns
from ledgerlens.operators.reconcile import RISK_RESIDUAL, FINANCE_RESIDUAL
from ledgerlens.plans.warehouse import Warehouse
from ledgerlens.schemas import ENTITY_REGISTRY

TOLERANCE = "0.01"


def _d(as_of: str):
    return F.lit(as_of).cast("date")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _rows(totals: DataFrame, *checks: tuple[str, str, Column | str]) -> DataFrame:
    """One row per check from the one row ``totals``."""
    return totals.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("check_id"), F.lit(text).alias("description"),
                 F.coalesce((F.expr(v) if isinstance(v, str) else v).cast("long"), F.lit(0)).alias("violations"))
        for i, text, v in checks])).alias("c")).select("c.*")


def _money(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column).cast("decimal(38,6)")), F.lit(0)).cast("decimal(38,6)")


def _together(*parts: DataFrame) -> DataFrame:
    """One-row aggregates with different columns as one row."""
    both = _union(list(parts))
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def business_key_columns(entity: str, columns: list[str]) -> list[str]:
    """Declared business key, plus ``as_of_date`` when the table is dated."""
    bk = list(ENTITY_REGISTRY[entity]["business_key"])
    if "as_of_date" in columns and "as_of_date" not in bk:
        bk.append("as_of_date")
    return bk


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """CHK-2 offenders: key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_canonical(canon: dict[str, DataFrame], as_of: str) -> DataFrame:
    """CHK-1, CHK-2, CHK-4, CHK-5, CHK-6 over the canonical model."""
    d = _d(as_of)
    out = []
    for entity, df in canon.items():
        # one pass per entity: group on the business key, then count rows and
        # duplicated keys from the groups (partial aggregation before the shuffle)
        keys = business_key_columns(entity, df.columns)
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_dups"))
        out.append(_rows(groups, (f"CHK-1 {entity}", "entity is not empty", "if(coalesce(n_rows, 0) = 0, 1, 0)"),
                         (f"CHK-2 {entity}", "business key is unique", "n_dups")))

    def orphans(df: DataFrame, of: DataFrame, keys: list[str]) -> DataFrame:
        return df.join(of.select(*keys), keys, "left_anti").agg(F.count(F.lit(1)).alias("n"))

    out.append(_rows(orphans(canon["position"].where(F.col("as_of_date") == d), canon["arrangement"],
                             ["arrangement_key", "as_of_date"]),
                     ("CHK-4 position", "every position has its arrangement", "n")))
    out.append(_rows(orphans(canon["collateral_allocation"], canon["collateral"], ["collateral_key", "as_of_date"]),
                     ("CHK-4 allocation", "every allocation has its collateral", "n")))
    # one row per party: the sets of its parents in both hierarchies
    parents = lambda kind: F.array_sort(F.collect_set(F.when(F.col("hierarchy_type") == kind, F.col("parent_party_key"))))
    party = canon["party_hierarchy"].where(F.col("as_of_date") == d).groupBy("child_party_key").agg(
        parents("LEGAL_OWNERSHIP").alias("legal"), parents("RISK_GROUP").alias("risk"),
        F.count_if((F.col("hierarchy_type") == "RISK_GROUP") & F.col("ownership_pct").isNotNull()).alias("owned"))
    out.append(_rows(party.agg(F.max((F.size("legal") > 0).cast("int")).alias("has_legal"),
                               F.max((F.size("risk") > 0).cast("int")).alias("has_risk"),
                               F.sum("owned").alias("owned"),
                               F.count_if((F.size("legal") > 0) & (F.size("risk") > 0) & (F.col("legal") != F.col("risk"))).alias("apart")),
                     ("CHK-5 types", "both hierarchy types present", "2 - coalesce(has_legal, 0) - coalesce(has_risk, 0)"),
                     ("CHK-5 ownership", "risk groups carry no ownership percentage", "owned"),
                     ("CHK-5 divergence", "the hierarchies differ for some party", "if(apart = 0, 1, 0)")))
    both = (canon["classification"].where((F.col("as_of_date") == d) & F.col("classification_scheme").isin(SECTOR_ACCOUNTING, SECTOR_PRUDENTIAL))
            .groupBy("arrangement_key").agg(F.countDistinct("classification_scheme").alias("schemes")))
    out.append(_rows(both.agg(F.count_if(F.col("schemes") == 2).alias("n")),
                     ("CHK-6 coexist", "some party carries both sector schemes", "if(n = 0, 1, 0)")))
    return _union(out)


def check_finance(detail: DataFrame, by_sector: DataFrame, arrangement: DataFrame,
                  trade_event: DataFrame, as_of: str) -> DataFrame:
    """CHK-7 .. CHK-10 over the finance lens."""
    d = _d(as_of)
    known = (detail.join(inception_dates(trade_event).select("arrangement_key", "accounting_date"), "arrangement_key", "left")
             .join(arrangement.where(F.col("as_of_date") == d).select("arrangement_key", "status"), "arrangement_key", "left"))
    asset, liability = F.col("asset_carrying_amount"), F.col("liability_fair_value")
    totals = _together(known.agg(
        F.count_if(asset < 0).alias("negative"), F.count_if((asset > 0) & (liability > 0)).alias("both_sides"),
        F.count_if(liability > 0).alias("liabilities"), F.count_if(F.col("accounting_date") > d).alias("late"),
        F.count_if(F.col("status") == "TERMINATED").alias("ended"),
        F.count_if(F.col("measurement_category").isNull()).alias("uncategorised"),
        _money("asset_carrying_amount").alias("in_detail")),
        by_sector.agg(_money("carrying_amount").alias("in_sectors")))
    return _rows(totals,
                 ("CHK-7 negative", "no negative asset amount", "negative"),
                 ("CHK-7 exclusive", "asset and liability sides are exclusive", "both_sides"),
                 ("CHK-7 liabilities", "negative derivatives are kept as liabilities", "if(liabilities = 0, 1, 0)"),
                 ("CHK-8 recognition", "no arrangement recognised after the date", "late"),
                 ("CHK-8 terminated", "terminated arrangements excluded", "ended"),
                 ("CHK-9 tie-out", "aggregate ties to detail within 0.01", f"if(abs(in_detail - in_sectors) > {TOLERANCE}, 1, 0)"),
                 ("CHK-10 category", "no null measurement category", "uncategorised"))


def check_risk(trades: DataFrame, sets: DataFrame, netting: DataFrame, arrangement: DataFrame,
               trade_event: DataFrame, collateral: DataFrame, allocation: DataFrame,
               classification: DataFrame, as_of: str) -> DataFrame:
    """CHK-11 .. CHK-14 over the risk lens.

    CHK-14 compares recognised collateral with the collateral that exists (financial
    assets after haircut), and each asset's allocations with its market value.
    """
    d = _d(as_of)
    assessed = classification.where((F.col("as_of_date") == d) & (F.col("classification_scheme") == SECTOR_PRUDENTIAL)).select(
        F.col("arrangement_key").alias("counterparty_party_key"), F.col("classification_value").alias("prudential"))
    # trades of one counterparty and sector are counted before they meet its assessment
    used = (trades.groupBy("counterparty_party_key", "counterparty_sector").agg(F.count(F.lit(1)).alias("n"))
            .join(assessed, "counterparty_party_key").where(F.col("counterparty_sector") != F.col("prudential")))
    known = (trades.join(inception_dates(trade_event).select("arrangement_key", "economic_event_date"), "arrangement_key", "left")
             .join(arrangement.where(F.col("as_of_date") == d).select("arrangement_key", "product_family"), "arrangement_key", "left"))
    given = allocation.where(F.col("as_of_date") == d).groupBy("collateral_key").agg(F.sum("allocated_value").alias("allocated"))
    assets = (collateral.where((F.col("as_of_date") == d) & F.col("is_financial_collateral"))
              .select("collateral_key", "market_value", F.coalesce("haircut_pct", F.lit(0)).alias("haircut"))
              .join(given, "collateral_key", "left")
              .withColumn("worth", F.col("market_value") * (F.lit(1) - F.col("haircut"))))
    eligible = F.col("netting_eligible")
    totals = _together(
        known.agg(F.count_if(F.col("replacement_cost") < 0).alias("negative_trades"),
                  F.count_if(F.col("economic_event_date") > d).alias("late"),
                  F.count_if(F.col("product_family") != "DERIVATIVE").alias("others"),
                  _money("collateral_after_haircut").alias("recognised")),
        sets.agg(F.count_if((F.col("netted_replacement_cost") < 0) | (F.col("exposure_at_default") < 0)).alias("negative_sets")),
        netting.agg(F.count_if(~eligible & (F.col("netting_benefit") != 0)).alias("unfounded"),
                    F.count_if(eligible & (F.col("netting_benefit") > 0)).alias("founded")),
        used.agg(F.sum("n").alias("other_sector")),
        assets.agg(_money("worth").alias("available"), F.count_if(F.col("allocated") > F.col("market_value")).alias("over")))
    return _rows(totals,
                 ("CHK-11 unenforceable", "no netting benefit where not enforceable", "unfounded"),
                 ("CHK-11 enforceable", "some netting benefit where enforceable", "if(founded = 0, 1, 0)"),
                 ("CHK-12 floors", "no negative replacement cost or exposure", "negative_trades + negative_sets"),
                 ("CHK-13 economic", "no trade with economic date after the date", "late"),
                 ("CHK-13 derivatives", "only derivatives in the risk lens", "others"),
                 ("CHK-13 sector", "the prudential assessment is the one used", "other_sector"),
                 ("CHK-14 collateral", "recognised collateral within available collateral", f"if(recognised > available + {TOLERANCE}, 1, 0)"),
                 ("CHK-14 asset", "no asset allocated beyond its value", "over"))


def check_reconciliation(rec_detail: DataFrame, fin_detail: DataFrame, trades: DataFrame,
                         disagreement: DataFrame) -> DataFrame:
    """CHK-15 .. CHK-17 over the reconciliation."""
    mark = lambda df, name: df.select("arrangement_key", F.lit(name).alias("from"))
    universe = _union([mark(fin_detail.where(F.col("product_family") == "DERIVATIVE"), "lens"), mark(trades, "lens"),
                       mark(rec_detail, "reason")]).groupBy("arrangement_key").agg(
        F.max((F.col("from") == "lens").cast("int")).alias("in_lens"), F.count_if(F.col("from") == "reason").alias("reasons"))
    both = F.col("in_finance_lens") & F.col("in_risk_lens")
    totals = _together(
        universe.agg(F.count_if(F.col("in_lens") != F.col("reasons")).alias("uncovered")),
        rec_detail.agg(F.count_if(F.col("difference_reason").isin(RISK_RESIDUAL, FINANCE_RESIDUAL)).alias("residual"),
                       F.count_if(both & (F.col("finance_asset_amount") != F.col("risk_replacement_cost"))).alias("disagree")),
        disagreement.agg(F.count(F.lit(1)).alias("published"), F.count_if(
            (F.col("accounting_sector") == F.col("prudential_sector")) | F.col("total_carrying_amount").isNull()).alias("unfounded")))
    return _rows(totals,
                 ("CHK-15 coverage", "every trade of either population has one reason", "uncovered"),
                 ("CHK-16 residual", "no unexplained residual", "residual"),
                 ("CHK-16 agreement", "trades in both lenses agree on the amount", "disagree"),
                 ("CHK-17 published", "disagreements are unequal and carry a materiality", "unfounded"),
                 ("CHK-17 not empty", "some disagreement is published", "if(published = 0, 1, 0)"))


def check_rerun(first: dict[str, DataFrame], second: dict[str, DataFrame]) -> DataFrame:
    """CHK-3: rows that a rerun of a load adds or loses, per table."""
    return _union([_rows(run_diff(df, second[name]).agg(F.count(F.lit(1)).alias("n")),
                         (f"CHK-3 {name}", "a rerun leaves the rows unchanged", "n")) for name, df in first.items()])


def check_rerun_runs(warehouse: Warehouse, first: str, second: str, tables: dict[str, tuple[str, ...]]) -> DataFrame:
    """CHK-3 over two published runs of the same loads: rows in which they differ, per table
    (name -> key), found by digests."""
    found = compare_runs(warehouse, first, second, {f"canon.{t}": keys for t, keys in tables.items()})
    counts = {t: found[f"canon.{t}"].count() for t in tables}
    return warehouse.spark.createDataFrame(
        [(f"CHK-3 {t}", "a rerun leaves the rows unchanged", n) for t, n in counts.items()],
        "check_id string, description string, violations long")


def check_lineage(spark: SparkSession, catalog: DataFrame, lineage: DataFrame, load_log: DataFrame,
                  figure: tuple[str, str] = ("finrep_assets_by_sector", "carrying_amount"),
                  derived: tuple[str, str, tuple[str, ...]] = (
                      "finrep_asset_detail", "asset_carrying_amount", ("fair_value", "carrying_amount"))) -> DataFrame:
    """CHK-18 over lineage, catalog and load log: every reporting column has lineage, the
    reported ``figure`` is traced over three steps at least to a source system, a ``derived``
    column names all its sources, no report reads a source system, every load is dated."""
    traced = trace(spark, lineage, *figure)
    table, column, wanted = derived
    named = lineage.where((F.col("target_table") == table) & (F.col("target_column") == column))
    totals = _together(
        unmapped_columns(catalog, lineage, layer="REPORTING").agg(F.count(F.lit(1)).alias("unmapped")),
        traced.agg(F.max("hop").alias("depth"), F.count_if(F.col("source_layer") == "SOURCE").alias("landed")),
        named.agg(F.count_distinct(F.when(F.col("source_column").isin(*wanted), F.col("source_column"))).alias("sources")),
        lineage.agg(F.count_if((F.col("target_layer") == "REPORTING") & (F.col("source_layer") == "SOURCE")).alias("bypasses")),
        load_log.agg(F.count(F.lit(1)).alias("loads"), F.count_if(F.col("as_of_date").isNull()).alias("undated")))
    return _rows(totals,
                 ("CHK-18 coverage", "every reporting column has lineage", "unmapped"),
                 ("CHK-18 depth", "the reported figure is traced over three steps or more", "if(coalesce(depth, 0) < 3, 1, 0)"),
                 ("CHK-18 landing", "the reported figure is traced to a source system", "if(landed = 0, 1, 0)"),
                 ("CHK-18 provenance", "a derived column names every source", f"{len(wanted)} - sources"),
                 ("CHK-18 bypass", "no report reads a source system", "bypasses"),
                 ("CHK-18 dated", "every load is logged with its date", "undated"),
                 ("CHK-18 logged", "some load is logged", "if(loads = 0, 1, 0)"))
