"""Plan-level guards for the scale rules, over every registered query."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import surrogate_key, surrogate_key_sql
from ledgerlens.operators import identity
from ledgerlens.queries import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin")


def _physical_plan(df) -> str:
    """The physical plan (AQE's initial plan; AQE re-plans joins at run time but
    never introduces a Python evaluation or a cartesian product)."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_no_cross_join(spark, name):
    plan = _physical_plan(QUERIES[name](spark, SF_SMALL))
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, (name, bad)


def test_hot_name_is_split_by_aqe_and_resolves_right(spark):
    """A third of the external records share one name: the N:1 probe of the
    name index is skewed, and AQE splits the hot partition."""
    n = 3000
    ref = spark.range(n).selectExpr(
        "concat('P', id) as src_party_id",
        "case when id = 0 then 'HOT NAME' else concat('Name ', id) end as legal_name",
        "cast(null as string) as lei", "'XX' as country")
    cbs = spark.range(n).selectExpr(
        "concat('C', id) as cbs_customer_id",
        "case when id % 3 = 0 then 'hot name' else concat('Name ', id) end as customer_name",
        "cast(null as string) as lei", "'xx' as country", "cast(null as string) as src_party_id_hint")
    trd = spark.range(0).selectExpr("cast(id as string) as trd_counterparty_id",
                                    "'' as counterparty_name", "'' as lei", "'' as country")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        xref = identity.resolve_party_identity(ref, cbs, trd)
        xref.collect()          # runs this Dataset's own query execution (final AQE plan)
        plan = xref._jdf.queryExecution().executedPlan().toString()
        mix = {r.resolution_method: r.parties for r in identity.method_mix(xref).collect()}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert mix == {"NATIVE": n, "NAME_COUNTRY": n}
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan[:2000]


def test_null_keys_are_dealt_over_all_tasks(spark, small_pipeline):
    """Half of the finance rows have no party: the shuffles of the party join hold even
    partitions all the same, and the result keeps the nulls."""
    from pyspark.sql import functions as F

    from ledgerlens.plans.mapping import spread_nulls, unspread
    left = spark.range(4000).selectExpr("concat('a', id) as a", "if(id % 2 = 0, null, concat('p', id % 900)) as p")
    right = spark.range(900).selectExpr("concat('p', id) as p", "id as v")
    joined = spread_nulls(left, "p", "a").join(right, "p", "left").withColumn("p", unspread("p"))
    assert joined.where("p is null").count() == 2000 and joined.where("v is not null").count() == 2000
    sizes = [r.n for r in spread_nulls(left, "p", "a").repartition(8, "p").groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8
    for name in ("fin_detail", "ccr_trade"):
        assert "concat(~" in _physical_plan(QUERIES[name](spark, SF_SMALL))


def test_broken_inputs_fail_the_checks(spark, small_pipeline):
    """Every added check can fail."""
    from pyspark.sql import functions as F

    from ledgerlens.operators import checks
    from ledgerlens.sources.testdata import AS_OF
    p, c, r = small_pipeline, small_pipeline.canon, small_pipeline.reports

    def ids(df):
        return {x.check_id for x in df.where("violations > 0").collect()}

    one = c["party_hierarchy"].where("hierarchy_type = 'LEGAL_OWNERSHIP'")
    same = one.unionByName(one.withColumn("hierarchy_type", F.lit("RISK_GROUP")).withColumn("ownership_pct", F.lit(None).cast("decimal(9,4)")))
    assert "CHK-5 divergence" in ids(checks.check_canonical({**c, "party_hierarchy": same}, AS_OF))
    fin = r.fin_detail.data.withColumn("liability_fair_value", F.lit(0).cast("decimal(20,2)"))
    assert "CHK-7 liabilities" in ids(checks.check_finance(fin, r.fin_by_sector.data, c["arrangement"], c["trade_event"], AS_OF))
    risk = lambda trades, netting, col: ids(checks.check_risk(
        trades, r.ccr_netting_set.data, netting, c["arrangement"], c["trade_event"], col, c["collateral_allocation"],
        c["classification"], AS_OF))
    broken = risk(r.ccr_trade.data.withColumn("counterparty_sector", F.lit("OTHER")),
                  r.rec_netting.data.withColumn("netting_benefit", F.lit(0).cast("decimal(38,2)")),
                  c["collateral"].withColumn("market_value", (F.col("market_value") * 1000).cast("decimal(20,2)")))
    assert broken == {"CHK-11 enforceable", "CHK-13 sector"}  # and with enough assets CHK-14 holds
    assert "CHK-17 not empty" in ids(checks.check_reconciliation(
        r.rec_detail, r.fin_detail.data, r.ccr_trade.data, r.rec_disagreement.data.where("false")))
    party = c["party"]
    assert ids(checks.check_rerun({"party": party}, {"party": party.where("party_key > '8'")})) == {"CHK-3 party"}


def test_risk_checks_build_the_trades_once(spark, small_pipeline):
    """The checks read the trade exposures as written: of the large tables their plan holds
    only what the checks need besides, and the rows are those of the lazy reports."""
    from ledgerlens.operators import checks
    from ledgerlens.sources.testdata import AS_OF
    p, c, r = small_pipeline, small_pipeline.canon, small_pipeline.reports
    lazy = checks.check_risk(r.ccr_trade.data, r.ccr_netting_set.data, r.rec_netting.data, c["arrangement"], c["trade_event"],
                             c["collateral"], c["collateral_allocation"], c["classification"], AS_OF)
    got = QUERIES["chk_risk"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, lazy.collect()))
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey")
    assert 3 * scans(got) < scans(lazy), (scans(got), scans(lazy))


def test_the_allocations_of_both_systems_are_dealt_once(spark):
    """Loads of one extract for two systems share its shuffles: a key, which is never null,
    leaves no test of its own below the extract's aggregate."""
    df = QUERIES["four_measures"](spark, SF_SMALL)
    below = [x for x in _physical_plan(df).splitlines() if "FileScan" in x and "l_partkey" in x]
    assert len(below) == 2 and not any("sha2" in x for x in below), below
    keys = spark.range(1).select(surrogate_key("id"), F.expr(surrogate_key_sql("'TRD'", "id")))
    assert [f.nullable for f in keys.schema] == [False, False]
