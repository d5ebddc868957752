"""Lineage mechanism micro-fixtures, upsert semantics, and the trace / audit rules."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import audit as A
from ledgerlens.operators import lineage as L
from ledgerlens.plans.mapping import ColumnMapping as C
from ledgerlens.plans.mapping import Mapping, apply_mapping, lineage_frame
from ledgerlens.plans.warehouse import Warehouse, keyed_upsert
from ledgerlens.schemas import LINEAGE_SCHEMA
from ledgerlens.sources.catalog import catalog_from_schemas
from tests.conftest import rows


def test_mapping_builds_data_and_lineage(spark):
    src = spark.createDataFrame([("x", "y")], "a string, b string")
    m = Mapping("T-1", "CANONICAL", "t", "SOURCE", "S", (
        C("a", "a", ("a",)), C("b_up", "upper(b)", ("b",), "upper-cased")))
    res = apply_mapping(spark, m, src)
    assert rows(res.data) == [("x", "Y")]
    lin = rows(res.lineage, "target_column", "source_table", "source_column")
    assert lin == [("a", "S", "a"), ("b_up", "S", "b")]
    cat = catalog_from_schemas(spark, {"CANONICAL": {"t": res.data}})
    assert L.unmapped_columns(cat, res.lineage, "t").count() == 0


def test_multi_table_sources_split_on_last_dot(spark):
    m = Mapping("T-2", "REPORTING", "r", "CANONICAL", "canon.a", (
        C("v", "1", ("canon.a.x", "canon.b.y")),))
    got = rows(lineage_frame(spark, [m]), "source_table", "source_column")
    assert got == [("canon.a", "x"), ("canon.b", "y")]


def test_constant_column_applied_twice_gives_one_row(spark):
    m = Mapping("T-3", "CANONICAL", "t", "SOURCE", "S", (C("k", "'K'", ()),))
    lin = lineage_frame(spark, [m, m])
    assert rows(lin, "target_column", "source_column") == [("k", "")]


def test_grouped_mapping(spark):
    src = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "g string, v int")
    m = Mapping("T-4", "REPORTING", "agg", "REPORTING", "d", (
        C("g", "g", ("g",)), C("n", "count(1)", ("g",), "rows"), C("s", "sum(v)", ("v",), "sum")),
        group_by=("g",))
    assert rows(m.build(src)) == [("a", 2, 3), ("b", 1, 5)]


def test_keyed_upsert_semantics(spark):
    schema = "k string, d string, v int"
    existing = spark.createDataFrame([("a", "D1", 1), ("b", "D1", 2), ("a", "D0", 9)], schema)
    incoming = spark.createDataFrame([("a", "D1", 10), ("c", "D1", 3)], schema)
    out = keyed_upsert(existing, incoming, ["k", "d"])
    # changed value wins, other date untouched, row missing from the rerun survives
    assert rows(out) == [("a", "D0", 9), ("a", "D1", 10), ("b", "D1", 2), ("c", "D1", 3)]
    # rerun with the same input is idempotent
    again = keyed_upsert(out, incoming, ["k", "d"])
    assert rows(again) == rows(out)


def test_warehouse_upsert_rewrites_only_touched_dates(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    schema = "k string, v int, as_of_date date"
    first = spark.sql("select * from values ('a', 1, date '2026-03-31'), "
                      "('b', 2, date '2026-03-31'), ('a', 5, date '2025-12-31') as t(k, v, as_of_date)")
    wh.upsert("canon.t", first, ("k", "as_of_date"))
    second = spark.sql("select * from values ('a', 10, date '2026-03-31') as t(k, v, as_of_date)")
    wh.upsert("canon.t", second, ("k", "as_of_date"))
    wh.upsert("canon.t", second, ("k", "as_of_date"))
    got = rows(wh.read("canon.t"), "k", "v")
    assert got == [("a", 5), ("a", 10), ("b", 2)]
    # a session left at the static default must not wipe the untouched date
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        third = spark.sql("select * from values ('b', 20, date '2026-03-31') as t(k, v, as_of_date)")
        wh.upsert("canon.t", third, ("k", "as_of_date"))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 5), ("a", 10), ("b", 20)]
    assert wh.tables("_staging") == []          # staged copies are removed after the swap


@pytest.mark.parametrize("partition_col", ["as_of_date", None])
def test_an_aborted_write_leaves_the_table(spark, tmpdir_path, partition_col):
    from ledgerlens.plans.warehouse import Warehouse
    wh = Warehouse(spark, tmpdir_path)
    good = spark.sql("select * from values ('a', 1, date '2026-03-31'), ('b', 2, date '2026-03-31') as t(k, v, as_of_date)")
    bad = good.selectExpr("k", "if(k = 'b', cast(raise_error('stopped') as int), v + 1) as v", "as_of_date")
    wh.upsert("canon.t", good, ("k", "as_of_date"), partition_col=partition_col)
    for write in (lambda: wh.upsert("canon.t", bad, ("k", "as_of_date"), partition_col=partition_col),
                  lambda: wh.replace("canon.t", bad), lambda: wh.append("canon.t", bad.withColumn("k", F.col("v").cast("string")), ("k",))):
        with pytest.raises(Exception):
            write()
        assert rows(wh.read("canon.t"), "k", "v") == [("a", 1), ("b", 2)] and wh.current("canon.t") == 1


def test_duplicate_keys_states_and_appends(spark, tmpdir_path):
    from ledgerlens.plans.warehouse import Warehouse
    wh = Warehouse(spark, tmpdir_path)
    wh.upsert("canon.t", spark.sql("select * from values ('a', 1), ('a', 3), ('b', 2) as t(k, v)"), ("k",), partition_col=None)
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 3), ("b", 2)]
    wh.append("canon.t", spark.sql("select * from values ('a', 9), ('c', 4), ('c', 4) as t(k, v)"), ("k",))
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 3), ("b", 2), ("c", 4)]
    wh.replace("canon.t", spark.sql("select 'z' as k, 0 as v where false"))
    assert wh.read("canon.t").count() == 0 and wh.read("canon.t", state=2).count() == 3
    wh.forget("canon.t", states=1)
    assert wh.read("canon.t").columns == ["k", "v"]


LIN = [
    # three-hop chain into a multi-source aggregate
    ("R1", "REPORTING", "agg", "total", "REPORTING", "rpt.detail", "amount", "sum of amounts", True),
    ("R2", "REPORTING", "detail", "amount", "CANONICAL", "canon.position", "fair_value", "sign rule", True),
    ("R2", "REPORTING", "detail", "amount", "CANONICAL", "canon.party", "name", "lookup", True),
    ("L1", "CANONICAL", "position", "fair_value", "SOURCE", "FIN_position", "fair_value", "typed", True),
    ("L2", "CANONICAL", "party", "name", "SOURCE", "REF_party", "legal_name", "trimmed", True),
    # a constant: empty source column fans out to every column of the source table
    ("R3", "REPORTING", "const", "flag", "CANONICAL", "canon.position", "", "constant", True),
    # a cycle between a and b
    ("C1", "CANONICAL", "a", "x", "CANONICAL", "canon.b", "y", "cyc", True),
    ("C2", "CANONICAL", "b", "y", "CANONICAL", "canon.a", "x", "cyc", True),
    # names where one contains the other
    ("N1", "CANONICAL", "y_x", "a", "CANONICAL", "canon.x", "a", "copy of x.a", True),
    ("N2", "CANONICAL", "x", "a", "CANONICAL", "canon.y_x", "a", "copy of y_x.a", True),
    # severed chain: source table has no lineage of its own
    ("S1", "REPORTING", "orphan", "v", "CANONICAL", "canon.nowhere", "v", "copy", True),
]


def test_trace_three_hops_multi_table(spark):
    lin = spark.createDataFrame(LIN, LINEAGE_SCHEMA)
    t = L.trace(spark, lin, "agg", "total")
    got = rows(t, "hop", "target_table", "source_table")
    assert got == [(1, "agg", "rpt.detail"), (2, "detail", "canon.party"),
                   (2, "detail", "canon.position"), (3, "party", "REF_party"),
                   (3, "position", "FIN_position")]
    s = L.trace_summary(t).collect()[0]
    assert s.max_hop == 3 and s.landing_sources == ["FIN_position", "REF_party"]


def test_trace_constant_fans_out_and_cycle_terminates(spark):
    lin = spark.createDataFrame(LIN, LINEAGE_SCHEMA)
    assert rows(L.trace(spark, lin, "const"), "hop", "target_table", "target_column") == \
        [(1, "const", "flag"), (2, "position", "fair_value")]
    cyc = rows(L.trace(spark, lin, "a"), "hop", "target_table")
    assert cyc == [(1, "a"), (2, "b")]
    # x.a is not mistaken for visited inside y_x.a
    sub = rows(L.trace(spark, lin, "y_x"), "hop", "target_table")
    assert sub == [(1, "y_x"), (2, "x")]


def test_reachability(spark):
    lin = spark.createDataFrame(LIN, LINEAGE_SCHEMA)
    tables = dict(rows(L.tables_reaching_source(lin), "table_name", "depth"))
    assert tables == {"position": 1, "party": 1, "detail": 2, "const": 2, "agg": 3}
    cols = set(rows(L.columns_reaching_source(lin), "target_table", "target_column"))
    assert ("agg", "total") in cols and ("orphan", "v") not in cols and ("a", "x") not in cols


def test_chains_of_any_length(spark):
    """Fifteen hops, with a branch at every table: complete trace, reach and impact."""
    from ledgerlens.operators import extensions as X
    n = 15
    chain = [(f"R{i}", "REPORTING" if i == 0 else "CANONICAL", f"t{i}", c, "SOURCE" if i == n - 1 else "CANONICAL",
              "SRC_x" if i == n - 1 else f"canon.t{i + 1}", s, "made of it", True)
             for i in range(n) for c in ("a", "b") for s in ("a", "b")]
    lin = spark.createDataFrame(chain, LINEAGE_SCHEMA)
    t = L.trace(spark, lin, "t0", "a")
    s = L.trace_summary(t).collect()[0]
    assert (s.max_hop, s.landing_sources) == (n, ["SRC_x"]) and s.trace_rows == 2 + 4 * (n - 1)
    assert L.tables_reaching_source(lin).count() == n
    assert X.impact(spark, lin, "SRC_x", "a").count() == 2 * n
    cat = spark.createDataFrame([("REPORTING", "t0", "a", 1)], "layer string, table_name string, column_name string, ordinal int")
    assert A.dp19_lineage_sufficient(cat, lin).where("severity = 'ERROR'").count() == 0


def _pipeline_audit_inputs(spark, p):
    from ledgerlens.schemas import ENTITY_SCHEMAS, registry_frame
    cat = catalog_from_schemas(spark, {"CANONICAL": ENTITY_SCHEMAS,
                                       "REPORTING": p.reports.tables()})
    return registry_frame(spark), cat, p.lineage()


def test_audit_on_the_built_warehouse(spark, small_pipeline):
    reg, cat, lin = _pipeline_audit_inputs(spark, small_pipeline)
    summary = {r.rule_id: r.status for r in
               A.audit_summary(spark, A.run_audit(reg, cat, lin)).collect()}
    assert summary.pop("DP-29") == "WARN"            # trade_event is event-dated
    assert set(summary.values()) == {"PASS"}


def test_audit_breakage(spark, small_pipeline):
    from pyspark.sql import functions as F
    reg, cat, lin = _pipeline_audit_inputs(spark, small_pipeline)
    # an undeclared column on a reporting table, and a badly named one
    extra = spark.createDataFrame([("REPORTING", "ccr_trade_exposure", "undeclared", 99),
                                   ("REPORTING", "ccr_trade_exposure", "TotalAmount", 100)],
                                  cat.schema)
    # a reporting row reading a source table directly
    bypass = spark.createDataFrame(
        [("X-1", "REPORTING", "finrep_asset_detail", "currency", "SOURCE", "CBS_account",
          "currency", "copy", True)], LINEAGE_SCHEMA)
    # the position loader's lineage deleted: chains through position no longer land
    severed = lin.where(F.col("target_table") != "position")
    f = A.run_audit(reg, cat.unionByName(extra), severed.unionByName(bypass))
    got = {(r.rule_id, r.severity, r.subject) for r in f.collect()}
    assert ("DP-18", "ERROR", "rpt.ccr_trade_exposure.undeclared") in got
    assert ("DP-16", "ERROR", "rpt.ccr_trade_exposure.TotalAmount") in got
    assert ("DP-10", "ERROR", "finrep_asset_detail.currency") in got
    assert ("DP-19", "ERROR", "rpt.ccr_trade_exposure.undeclared") in got
    s = {r.rule_id: r.status for r in A.audit_summary(spark, f).collect()}
    assert s["DP-10"] == s["DP-16"] == s["DP-18"] == s["DP-19"] == "FAIL"
    strict = {r.rule_id: r.status for r in A.audit_summary(spark, f, strict=True).collect()}
    assert strict["DP-29"] == "FAIL"
    # the verdict replaces the linter's exit code: clean passes, broken fails
    assert A.audit_verdict(A.audit_summary(spark, f)).collect()[0].conformant is False
    clean = A.run_audit(reg, cat, lin)
    v = A.audit_verdict(A.audit_summary(spark, clean)).collect()[0]
    assert v.conformant is True and v.passed == 8 and v.warned == 1
    assert A.audit_verdict(A.audit_summary(spark, clean, strict=True)).collect()[0] \
        .conformant is False


def test_audit_of_an_empty_warehouse_reports_instead_of_failing(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path + "/nothing-here")
    findings, summary = A.audit_warehouse(spark, wh)
    assert findings.count() == 0            # no tables: only registry rules can fire
    assert {r.status for r in summary.collect()} == {"PASS"}


def test_registry_rules(spark):
    from ledgerlens.schemas import registry_frame
    reg = registry_frame(spark, {
        "good": dict(owner="o", steward="s", business_key=["src_id"], golden_source="g",
                     definition="A perfectly reasonable definition that is long enough to pass."),
        "bad": dict(owner="", steward=None, business_key=[], golden_source="",
                    definition="bad thing"),
        "surrogates": dict(owner="o", steward="s", business_key=["a_key", "b_key"],
                           golden_source="g",
                           definition="Surrogates only; still a definition long enough to pass."),
        "named_entity": dict(owner="o", steward="s", business_key=["x"], golden_source="g",
                             definition="Named entity is what this is, restated at length here."),
    })
    cat = catalog_from_schemas(spark, {"CANONICAL": {}})
    f = {(r.rule_id, r.severity, r.subject) for r in A.run_audit(
        reg, cat, spark.createDataFrame([], LINEAGE_SCHEMA)).collect()}
    assert {("DP-01", "ERROR", "bad"), ("DP-01", "WARN", "bad"), ("DP-05", "ERROR", "bad"),
            ("DP-15", "WARN", "bad"), ("DP-36", "ERROR", "bad"),
            ("DP-05", "WARN", "surrogates"), ("DP-15", "WARN", "named_entity")} <= f
    assert not any(s == "good" for _, _, s in f)
