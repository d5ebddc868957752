"""Extensions that run on metadata or need a controlled fixture, plus the stream."""


import pytest
from decimal import Decimal as Dec

from pyspark.sql import functions as F

from ledgerlens.operators import extensions as X
from ledgerlens.operators import lineage as L
from tests.conftest import rows


def test_bitemporal_read(spark):
    df = spark.sql("""select * from values
        ('A', date '2026-01-31', date '2026-02-02', 10),
        ('A', date '2026-01-31', date '2026-02-20', 11),   -- restatement of January
        ('A', date '2026-02-28', date '2026-03-02', 12),
        ('B', date '2026-02-28', date '2026-03-02', 5)
        as t(k, valid, known, v)""")
    # January as first reported vs as corrected
    assert rows(X.as_known_at(df, ["k"], "valid", "known", "2026-01-31", "2026-02-10"), "k", "v") == [("A", 10)]
    assert rows(X.as_known_at(df, ["k"], "valid", "known", "2026-01-31", "2026-02-25"), "k", "v") == [("A", 11)]
    assert rows(X.as_known_at(df, ["k"], "valid", "known", "2026-03-31", "2026-03-31"), "k", "v") == [("A", 12), ("B", 5)]


def test_restatement_delta_is_explained(spark):
    before = spark.sql("select * from values ('A', 10.00), ('B', 5.00), ('C', 1.00) as t(k, v)")
    after = spark.sql("select * from values ('A', 10.004), ('B', 7.00), ('D', 3.00) as t(k, v)")
    d = {r.k: (r.reason, r.delta) for r in X.tolerance_reconcile(before, after, ["k"], "v").collect()}
    assert d == {"A": ("MATCH", Dec("0.00")), "B": ("CHANGED", Dec("2.00")),
                 "C": ("ONLY_BEFORE", Dec("-1.00")), "D": ("ONLY_AFTER", Dec("3.00"))}


def test_run_diff_and_versions(spark):
    a = spark.sql("select * from values (1, 'x'), (2, 'y'), (2, 'y') as t(k, v)")
    b = spark.sql("select * from values (1, 'x'), (2, 'y'), (3, 'z') as t(k, v)")
    assert rows(X.run_diff(a, b), "k", "side") == [(2, "only_a"), (3, "only_b")]
    pub = X.with_version(a, "run-1", "v1").unionByName(X.with_version(b, "run-2", "v2"))
    assert {r.run_id for r in X.latest_version(pub, []).collect()} == {"run-2"}


def test_rejects_and_quality_rules(spark):
    src = spark.sql("select * from values ('1.50', '2026-01-31'), ('n/a', '2026-02-30'), "
                    "('', '2026-03'), (null, 'x') as t(pct, d)")
    from ledgerlens.functions import try_date_sql
    rej = X.rejects(src, {"pct": "try_cast(pct as decimal(9,4))", "d": try_date_sql("d")}, "R1")
    assert rows(rej, "source_column", "raw_value") == [
        ("d", "2026-02-30"), ("d", "2026-03"), ("d", "x"), ("pct", "n/a")]
    t = spark.sql("select * from values (1, 'ACTIVE'), (-1, 'ACTIVE'), (2, 'BOGUS'), (null, null) "
                  "as t(amount, status)")
    rules = [X.QualityRule("Q1", "t", "validity", "WARN", "flag", "amount >= 0"),
             X.QualityRule("Q2", "t", "validity", "ERROR", "quarantine", "status in ('ACTIVE')")]
    res = {r.rule_id: (r.failed_rows, r.total_rows) for r in X.evaluate_rules({"t": t}, rules).collect()}
    assert res == {"Q1": (2, 4), "Q2": (2, 4)}
    clean, quarantined = X.split_quarantine(t, rules)
    assert clean.count() == 2 and quarantined.count() == 2


def test_effective_dated_codes_and_golden_value(spark):
    codes = spark.sql("""select * from values
        ('S', 'OLD', date '2000-01-01', date '2020-01-01'),
        ('S', 'NEW', date '2020-01-01', cast(null as date)) as t(code, mapped_value, valid_from, valid_to)""")
    df = spark.sql("select * from values ('S', date '2019-12-31'), ('S', date '2020-01-01'), "
                   "('Q', date '2020-01-01') as t(c, d)")
    assert rows(X.map_effective_codes(df, "c", "d", codes), "c", "mapped_value") == \
        [("Q", None), ("S", "NEW"), ("S", "OLD")]
    assert rows(X.unmapped_codes(df, "c", "d", codes)) == [("Q", 1)]
    cand = spark.sql("select * from values ('p', null, 1), ('p', 'trd', 2), ('p', 'cbs', 3), "
                     "('q', 'ref', 1), ('q', 'trd', 2) as t(k, v, prec)")
    assert rows(X.golden_value(cand, "k", "v", "prec")) == [("p", "trd", 2), ("q", "ref", 1)]


def test_hierarchy_cycles_exact_on_single_parent_graph(spark):
    edges = spark.sql("""select 'LEGAL_OWNERSHIP' as hierarchy_type, date '2026-03-31' as as_of_date,
        c as child_party_key, p as parent_party_key from values
        ('a', 'b'), ('b', 'c'), ('c', 'a'),      -- a three-cycle
        ('d', 'a'), ('e', 'd'),                  -- a tail into it
        ('f', 'g'), ('g', 'h'),                  -- a plain chain
        ('s', 's')                               -- a self-loop
        as t(c, p)""")
    got = rows(X.hierarchy_cycles(edges), "child_party_key", "parent_party_key")
    assert got == [("a", "b"), ("b", "c"), ("c", "a"), ("s", "s")]


def test_hierarchy_cycles_with_several_parents(spark):
    edges = spark.sql("""select 'LEGAL_OWNERSHIP' as hierarchy_type, date '2026-03-31' as as_of_date,
        c as child_party_key, p as parent_party_key from values
        ('a', 'b'), ('b', 'a'), ('b', 'c'), ('c', 'd'), ('d', 'c'),  -- two cycles and the edge between
        ('m', 'n'), ('n', 'o'), ('o', 'm'), ('n', 'q'), ('q', 'm'),  -- cycles that share a party
        ('t', 'a'), ('d', 'u')                                        -- tails
        as t(c, p)""")
    got = rows(X.hierarchy_cycles(edges), "child_party_key", "parent_party_key")
    assert got == [("a", "b"), ("b", "a"), ("c", "d"), ("d", "c"), ("m", "n"), ("n", "o"), ("n", "q"),
                   ("o", "m"), ("q", "m")]


def test_queries_with_content(spark):
    """Rows that prove something: every restatement reason, cycles, unknown parents, and a
    restatement that only the later reading knows."""
    from ledgerlens.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    assert {r.reason for r in QUERIES["ext_restatement_summary"](spark, sf).collect()} == \
        {"MATCH", "CHANGED", "ONLY_ORIGINAL", "ONLY_RESTATED"}
    assert QUERIES["ext_hierarchy_unknown_parents"](spark, sf).count() > 0
    assert QUERIES["ext_hierarchy_cycles"](spark, sf).count() > 4
    known = QUERIES["ext_position_as_known"](spark, sf)
    assert known.groupBy("arrangement_key").agg(F.countDistinct("carrying_amount").alias("n")).where("n = 2").count() > 0


def test_block_rules_stop_a_publication(spark):
    rules = [X.QualityRule("B", "t", "validity", "ERROR", "block", "v > 0"), X.QualityRule("F", "u", "validity", "WARN", "flag", "v > 0")]
    good, bad = spark.sql("select 1 as v"), spark.sql("select -1 as v")
    X.require_publishable(X.evaluate_rules({"t": good, "u": bad}, rules))
    with pytest.raises(ValueError, match="t"):
        X.require_publishable(X.evaluate_rules({"t": bad, "u": good}, rules))


def test_conversion_never_passes_an_amount_through(spark):
    df = spark.sql("select * from values ('EUR', 10.00), ('USD', 10.00), ('XXX', 10.00) as t(currency, a)")
    rates = spark.sql("select * from values ('EUR', 1.0), ('USD', 0.9) as t(currency, rate)")
    got = rows(X.converted(df, ["a"], rates, "EUR"), "currency", "a", "converted_to")
    assert [(c, None if a is None else float(a), t) for c, a, t in got] == [("EUR", 10.0, "EUR"), ("USD", 9.0, "EUR"), ("XXX", None, "EUR")]


def test_schema_change_classification(spark):
    old = spark.createDataFrame([("t", "a", "int"), ("t", "b", "decimal(20,2)"),
                                 ("t", "c", "string"), ("t", "d", "string")],
                                "table_name string, column_name string, data_type string")
    new = spark.createDataFrame([("t", "a", "bigint"), ("t", "b", "decimal(22,2)"),
                                 ("t", "c", "int"), ("t", "e", "date")],
                                "table_name string, column_name string, data_type string")
    got = {r.column_name: r.classification for r in X.classify_schema_change(old, new).collect()}
    assert got == {"a": "compatible", "b": "compatible", "c": "breaking", "d": "breaking",
                   "e": "additive"}


def test_impact_and_lineage_completeness(spark, small_pipeline):
    lin = small_pipeline.lineage()
    hit = {(r.target_table, r.target_column) for r in
           X.impact(spark, lin, "FIN_position", "fair_value").collect()}
    assert ("position", "fair_value") in hit
    assert ("ccr_exposure_by_netting_set", "netted_replacement_cost") in hit
    assert ("finrep_assets_by_sector", "carrying_amount") in hit
    stamped = X.stamp_lineage(lin, "run-1", "abc123", "1998-06-30", small_pipeline.mappings())
    assert X.incomplete_lineage(stamped).count() == 0
    assert X.incomplete_lineage(X.stamp_lineage(lin, "run-1", "abc123", "1998-06-30")).count() == lin.count()
    said = {r.rule_id: r.predicate for r in stamped.select("rule_id", "predicate").distinct().collect()}
    assert said["LD-APR-CBS-001"] == "party_key is not null" and said["RPT-RECON-001"].endswith("by difference_reason")
    assert "not terminated" in said["RPT-FINREP-001"]
    assert X.incomplete_lineage(X.stamp_lineage(lin, "", "abc123", "1998-06-30")).count() == lin.count()
    diff = X.lineage_diff(lin, lin.where(F.col("rule_id") != "LD-POS-001"))
    assert diff.where("side = 'removed'").count() == lin.where("rule_id = 'LD-POS-001'").count()


def test_validators(spark):
    df = spark.createDataFrame([("529900T8BM49AURSDO55", "US0378331005"),
                                ("529900T8BM49AURSDO56", "US0378331006"),
                                ("bad", None)], "lei string, isin string")
    got = [(r.lei_checksum_ok, r.isin_checksum_ok) for r in
           X.validate_isin(X.validate_lei(df)).collect()]
    assert got[0] == (True, True) and got[1] == (False, False) and got[2][0] is False


def test_reconciliation_walk(spark):
    schema = ("arrangement_key string, in_finance_lens boolean, in_risk_lens boolean, "
              "finance_asset_amount decimal(20,2), finance_liability_amount decimal(20,2), "
              "risk_replacement_cost decimal(20,2), difference_reason string")
    rows = [("A", True, True, Dec("10.00"), Dec("0"), Dec("10.00"), "IN BOTH"),
            ("B", True, False, Dec("4.00"), Dec("0"), Dec("0"), "FIN INACTIVE"),
            ("C", False, True, Dec("0"), Dec("0"), Dec("7.00"), "RISK LATE")]
    walk = {(r.step, r.item): r.amount for r in
            X.reconciliation_walk(spark.createDataFrame(rows, schema)).collect()}
    assert walk == {(0, X.WALK_START): Dec("14.00"), (1, "FIN INACTIVE"): Dec("-4.00"),
                    (2, "RISK LATE"): Dec("7.00"), (3, X.WALK_BOTH): Dec("0.00"),
                    (4, X.WALK_RESIDUAL): Dec("0.00"), (5, X.WALK_END): Dec("17.00")}
    empty = X.reconciliation_walk(spark.createDataFrame([], schema)).collect()
    assert sorted((r.step, r.amount) for r in empty) == [(0, 0), (3, 0), (4, 0), (5, 0)]
