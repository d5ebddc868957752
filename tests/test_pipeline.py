"""Whole-pipeline properties on the driver's smallest tables."""

from ledgerlens.plans.pipeline import run_pipeline, pipeline_from_warehouse
from ledgerlens.plans.warehouse import Warehouse
from ledgerlens.queries import QUERIES
from ledgerlens.sources.testdata import AS_OF
from ledgerlens.sources.testdata import testdata_extracts as extracts_of
from tests.conftest import SF_SMALL


def test_every_integrity_check_holds(spark):
    # The adapted data holds one genuine finding: a few loans/deposits whose
    # carrying amount (order price less line discounts) is negative; the sign
    # rule only guards derivatives, so CHK-7 reports exactly those rows.
    fin = QUERIES["fin_detail"](spark, SF_SMALL)
    negative_carrying = fin.where("product_family <> 'DERIVATIVE' and "
                                  "asset_carrying_amount < 0").count()
    # It holds another: whole line prices are allocated to assets worth less, so
    # assets are over-allocated and recognised collateral exceeds what exists.
    expected = {"CHK-7 negative": negative_carrying}
    for name in ("chk_canonical", "chk_rerun", "chk_finance", "chk_risk", "chk_reconciliation"):
        got = {r.check_id: r.violations for r in QUERIES[name](spark, SF_SMALL).collect()}
        if name == "chk_risk":
            assert got.pop("CHK-14 collateral") == 1 and got.pop("CHK-14 asset") > 0
        bad = {k: v for k, v in got.items() if v != expected.get(k, 0)}
        assert bad == {}, (name, bad)


def test_population_reasons_are_all_named(spark):
    got = {r.difference_reason for r in QUERIES["rec_population"](spark, SF_SMALL).collect()}
    assert not any("unexplained" in g for g in got)
    assert "IN BOTH" in got


def test_rerun_is_idempotent(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    first = run_pipeline(spark, extracts_of(spark, SF_SMALL), AS_OF, wh)
    snap = {t: wh.read(f"canon.{t}").persist() for t in
            ("party", "arrangement", "position", "trade_event", "collateral_allocation")}
    for df in snap.values():
        df.count()
    second = run_pipeline(spark, extracts_of(spark, SF_SMALL), AS_OF, wh)
    assert first == second
    for t, before in snap.items():
        after = wh.read(f"canon.{t}")
        assert after.exceptAll(before).count() == 0, t
        assert before.exceptAll(after).count() == 0, t
    log = wh.load_log()
    assert log.count() == log.select("rule_id", "target", "as_of_date").distinct().count()
    assert log.where("as_of_date is null").count() == 0
    assert wh.lineage().count() == 185
    # a derived column names every source it reads
    srcs = {r.source_column for r in wh.lineage().where(
        "target_table = 'finrep_asset_detail' and target_column = 'asset_carrying_amount'")
        .collect()}
    assert {"fair_value", "carrying_amount"} <= srcs
    # the strong match does more work than the weak one, and the weak one is flagged
    mix = {r.resolution_method: r.n for r in wh.read("stg.party_xref")
           .groupBy("resolution_method").count().withColumnRenamed("count", "n").collect()}
    assert mix["LEI"] > mix["NAME_COUNTRY"] > 0
    # the built warehouse audits clean: one WARN for the event-dated trade_event
    from ledgerlens.operators.audit import audit_warehouse
    findings, summary = audit_warehouse(spark, wh)
    assert [(r.rule_id, r.severity, r.subject) for r in findings.collect()] == \
        [("DP-29", "WARN", "canon.trade_event")]
    status = {r.rule_id: r.status for r in summary.collect()}
    assert status.pop("DP-29") == "WARN" and set(status.values()) == {"PASS"}
    assert wh.catalog().where("layer = 'REPORTING'").select("table_name").distinct().count() == 7


def test_warehouse_served_queries_equal_lazy_ones(spark, tmpdir_path):
    from ledgerlens.queries import pipeline, bind_pipeline
    wh = Warehouse(spark, tmpdir_path)
    run_pipeline(spark, extracts_of(spark, SF_SMALL), AS_OF, wh)
    lazy = {n: sorted(map(tuple, QUERIES[n](spark, SF_SMALL).collect()))
            for n in ("fin_by_sector", "ccr_netting_set", "rec_population", "load_log")}
    key_dir = SF_SMALL + "/"          # a second name for the same data, bound to the warehouse
    bind_pipeline(spark, key_dir, pipeline_from_warehouse(
        spark, extracts_of(spark, SF_SMALL), AS_OF, wh))
    for n, want in lazy.items():
        assert sorted(map(tuple, QUERIES[n](spark, key_dir).collect())) == want, n


def test_second_reporting_date_does_not_leak(spark, tmpdir_path):
    """Two runs for two dates into one warehouse: each date reads only itself."""
    from ledgerlens.plans.pipeline import build_reports
    from ledgerlens.sources.testdata import PRIOR_AS_OF
    wh = Warehouse(spark, tmpdir_path)
    run_pipeline(spark, extracts_of(spark, SF_SMALL), AS_OF, wh)
    before = {t: sorted(map(tuple, wh.read(f"rpt.{t}").collect()))
              for t in ("finrep_assets_by_sector", "ccr_exposure_by_netting_set")}
    arr_before = wh.read("canon.arrangement").count()
    run_pipeline(spark, extracts_of(spark, SF_SMALL), PRIOR_AS_OF, wh)
    arr = wh.read("canon.arrangement")
    assert arr.count() == 2 * arr_before
    assert {r.as_of_date.isoformat() for r in arr.select("as_of_date").distinct().collect()} \
        == {AS_OF, PRIOR_AS_OF}
    canon = {t: wh.read(f"canon.{t}") for t in
             ("arrangement", "position", "arrangement_party_role", "party", "classification",
              "trade_event", "netting_set", "collateral", "collateral_allocation")}
    again = build_reports(spark, canon, AS_OF)
    assert sorted(map(tuple, again.fin_by_sector.data.collect())) == \
        before["finrep_assets_by_sector"]
    assert sorted(map(tuple, again.ccr_netting_set.data.collect())) == \
        before["ccr_exposure_by_netting_set"]
    log = wh.load_log()
    assert log.select("as_of_date").distinct().count() == 2
