"""Runs, write-audit-publish, conflicts, bucketed tables, rerun digests, landing rejects, code lists."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import packed_key, unpacked_key
from ledgerlens.operators import digests
from ledgerlens.operators import extensions as X
from ledgerlens.operators.checks import check_rerun_runs
from ledgerlens.plans.pipeline import dated_canon, pipeline_from_warehouse, run_pipeline
from ledgerlens.plans.publication import Blocked, audit_run, publish_audited
from ledgerlens.plans.warehouse import Conflict, Warehouse
from ledgerlens.session import shuffles_released
from ledgerlens.sources.extracts import EXTRACT_COLUMNS, landing_counts, read_extract, read_rejects
from ledgerlens.sources.testdata import AS_OF
from ledgerlens.sources.testdata import testdata_extracts as extracts_of
from tests.conftest import SF_SMALL, rows


def rows_of(df, *cols):
    """Rows as tuples, in no order (dates may be missing)."""
    return list(map(tuple, df.select(*cols).collect()))


def table(spark, *values):
    return spark.createDataFrame(values, "k string, v int, as_of_date string").withColumn("as_of_date", F.to_date("as_of_date"))


def test_a_run_is_seen_whole_or_not_at_all(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    one = wh.run("one", "v1")
    one.upsert("canon.t", table(spark, ("a", 1, "2026-03-31"), ("b", 2, "2026-03-31")), ("k", "as_of_date"))
    one.replace("rpt.sum", spark.sql("select 3 as s"))
    assert not wh.exists("canon.t") and one.read("canon.t").count() == 2  # staged: its own eyes only
    one.publish()
    two = wh.run("two", "v2", "2026-06-30")
    two.upsert("canon.t", table(spark, ("a", 10, "2026-03-31"), ("c", 5, "2026-06-30")), ("k", "as_of_date"))
    reader = wh.at()
    two.replace("rpt.sum", spark.sql("select 17 as s"))
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 1), ("b", 2)] and rows(wh.read("rpt.sum")) == [(3,)]
    two.publish()
    # a reader that began before stays on its run; a new one sees the new run in every table
    assert rows(reader.read("canon.t"), "k", "v") == [("a", 1), ("b", 2)] and rows(reader.read("rpt.sum")) == [(3,)]
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 10), ("b", 2), ("c", 5)] and rows(wh.read("rpt.sum")) == [(17,)]
    assert rows(wh.at("one").read("canon.t"), "k", "v") == [("a", 1), ("b", 2)]
    assert [(r["run_id"], r["code_version"], r["as_of_date"]) for r in wh.runs()] == [("one", "v1", None), ("two", "v2", "2026-06-30")]
    # every row says which run wrote its folder
    three = wh.run("three", "v3")
    three.upsert("canon.t", table(spark, ("d", 7, "2026-06-30")), ("k", "as_of_date"))
    three.publish()
    assert rows(wh.read("canon.t", stamped=True), "k", "run_id", "code_version") == [
        ("a", "two", "v2"), ("b", "two", "v2"), ("c", "three", "v3"), ("d", "three", "v3")]
    with pytest.raises(ValueError, match="never published again"):
        wh.run("two", "v9")
    with pytest.raises(ValueError, match="for reading"):
        reader.replace("rpt.sum", spark.sql("select 0 as s"))
    with pytest.raises(KeyError):
        wh.at("nobody")


def test_an_abandoned_run_leaves_nothing(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    wh.upsert("canon.t", table(spark, ("a", 1, "2026-03-31")), ("k", "as_of_date"))
    before = sorted(os.listdir(os.path.join(tmpdir_path, "canon", "t")))
    run = wh.run("r", "v1")
    run.upsert("canon.t", table(spark, ("a", 2, "2026-03-31")), ("k", "as_of_date"))
    run.upsert("canon.t", table(spark, ("b", 3, "2026-03-31")), ("k", "as_of_date"))
    assert rows(run.read("canon.t"), "k", "v") == [("a", 2), ("b", 3)]
    run.abandon()
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 1)] and wh.current("canon.t") == 1
    left = sorted(os.listdir(os.path.join(tmpdir_path, "canon", "t")))
    assert len([x for x in left if x.startswith("version=")]) <= len([x for x in before if x.startswith("version=")]) + 1


def test_of_two_writers_none_is_lost(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    wh.upsert("canon.t", table(spark, ("a", 1, "2026-03-31")), ("k", "as_of_date"))
    one, two, other = wh.run("one", "v1"), wh.run("two", "v1"), wh.run("other", "v1")
    one.upsert("canon.t", table(spark, ("b", 2, "2026-03-31")), ("k", "as_of_date"))
    two.upsert("canon.t", table(spark, ("c", 3, "2026-03-31")), ("k", "as_of_date"))
    other.replace("rpt.other", spark.sql("select 1 as x"))
    one.publish()
    with pytest.raises(Conflict, match="canon.t"):
        two.publish()
    other.publish()  # another table: no conflict, and the first run's table stays
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 1), ("b", 2)] and wh.exists("rpt.other")
    # a single write that comes second starts again on the newer table
    original, calls = Warehouse._commit, []

    def late(self, changed, base):
        if not calls:
            calls.append(1)
            Warehouse(spark, tmpdir_path).upsert("canon.t", table(spark, ("d", 4, "2026-03-31")), ("k", "as_of_date"))
        return original(self, changed, base)
    Warehouse._commit = late
    try:
        wh.upsert("canon.t", table(spark, ("e", 5, "2026-03-31")), ("k", "as_of_date"))
    finally:
        Warehouse._commit = original
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 1), ("b", 2), ("d", 4), ("e", 5)]


def test_snapshot_and_untouched_dates(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    wh.upsert("canon.t", table(spark, ("a", 1, "2026-03-31"), ("b", 2, "2026-03-31"), ("a", 9, "2025-12-31"), ("n", 0, None)), ("k", "as_of_date"))
    wh.upsert("canon.t", table(spark, ("a", 3, "2026-03-31")), ("k", "as_of_date"), snapshot=True)
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 3), ("a", 9), ("n", 0)]
    wh.upsert("canon.t", table(spark, ("m", 4, None)), ("k", "as_of_date"))
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 3), ("a", 9), ("m", 4), ("n", 0)]


def test_an_append_reads_only_the_months_that_arrive(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    ev = lambda *v: spark.createDataFrame(v, "e string, d string, x int")
    wh.append("canon.ev", ev(("1", "2026-01-05", 1), ("2", "2026-02-05", 2)), ("e",), month="substr(d, 1, 7)")
    january = [s for s in wh._state("canon.ev")["segments"] if s[1] == "_month=2026-01"][0]
    fs, p = wh._hadoop(f"{wh.path('canon.ev')}/version={january[0]}/{january[1]}")
    wh.append("canon.ev", ev(("2", "2026-02-05", 9), ("3", "2026-02-07", 3), ("3", "2026-02-07", 3)), ("e",), month="substr(d, 1, 7)")
    assert rows(wh.read("canon.ev")) == [("1", "2026-01-05", 1), ("2", "2026-02-05", 2), ("3", "2026-02-07", 3)]
    for i in range(4):
        wh.append("canon.ev", ev((f"n{i}", "2026-02-09", i)), ("e",), month="substr(d, 1, 7)")
    wh.compact("canon.ev", most=2)
    assert len(wh._state("canon.ev")["segments"]) == 2 and wh.read("canon.ev").count() == 7
    # January is not touched by a February delivery: even unreadable it does not matter
    fs.delete(p, True)
    wh.append("canon.ev", ev(("4", "2026-02-08", 4)), ("e",), month="substr(d, 1, 7)")
    assert wh.current("canon.ev") == 8


RULES = [X.QualityRule("B", "t", "validity", "ERROR", "block", "v is null or v < 100"), X.QualityRule("Q", "t", "validity", "ERROR", "quarantine", "v > 0"),
         X.QualityRule("F", "u", "validity", "WARN", "flag", "v > 0")]
KEYS = {"t": ("k", "as_of_date"), "u": ("k", "as_of_date")}


def staged(wh, spark, run_id, *values):
    run = wh.run(run_id, "v1")
    for t in ("t", "u"):
        run.upsert(f"canon.{t}", table(spark, *values), KEYS[t])
    return run


def test_write_audit_publish(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    run = staged(wh, spark, "good", ("a", 1, "2026-03-31"), ("z", -1, "2026-03-31"), ("y", None, "2026-03-31"))
    assert audit_run(run, RULES, keys=KEYS) == []
    publish_audited(run, [])
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 1)] and wh.read("canon.u").count() == 3
    assert sorted((r.k, r.v, tuple(r.failed_rules)) for r in wh.read("quar.t").collect()) == [("y", None, ("Q",)), ("z", -1, ("Q",))]
    # a failing block rule: no table changes, the evidence is there
    run = staged(wh, spark, "bad", ("b", 500, "2026-06-30"))
    with pytest.raises(Blocked, match="canon.t"):
        publish_audited(run, audit_run(run, RULES, keys=KEYS))
    assert rows(wh.read("canon.t"), "k", "v") == [("a", 1)] and wh.read("canon.u").count() == 3
    got = {(r.run_id, r.rule_id): r.failed_rows for r in wh.read("meta.dq_result").collect()}
    assert got == {("good", "B"): 0, ("good", "Q"): 2, ("good", "F"): 2, ("bad", "B"): 1, ("bad", "Q"): 0, ("bad", "F"): 0}
    # table by table
    run = staged(wh, spark, "part", ("b", 500, "2026-06-30"))
    publish_audited(run, audit_run(run, RULES, keys=KEYS), whole=False)
    assert wh.read("canon.t").count() == 1 and wh.read("canon.u").count() == 4


def test_the_runner_stops_at_a_block_rule(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    x = extracts_of(spark, SF_SMALL)
    rule = X.QualityRule("DQ", "position", "validity", "ERROR", "block", "carrying_amount >= 0")
    with pytest.raises(Blocked, match="canon.position"):
        run_pipeline(spark, x, AS_OF, wh, run_id="r1", rules=[rule])
    assert not wh.exists("canon.position") and not wh.exists("rpt.finrep_asset_detail")
    assert wh.tables("canon") == [] and wh.catalog().count() == 0
    assert wh.read("meta.dq_result").where("failed_rows > 0").count() == 1
    held = X.QualityRule("DQ", "arrangement", "validity", "ERROR", "quarantine", "original_notional is not null")
    run_pipeline(spark, x, AS_OF, wh, run_id="r2", code_version="abc", rules=[held])
    assert wh.read("canon.arrangement").where("original_notional is null").count() == 0 < wh.read("quar.arrangement").count()
    assert [r["run_id"] for r in wh.runs()] == ["r1", "r2"] and wh.runs()[1]["code_version"] == "abc"
    # no exchange on the arrangement for the canonical sides, and the same figures
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        p = pipeline_from_warehouse(spark, x, AS_OF, wh)
        plan = {n: r.data._jdf.queryExecution().executedPlan().toString() for n, r in (
            ("fin", p.reports.fin_detail), ("ccr", p.reports.ccr_trade))}
    finally:
        for k in conf:
            spark.conf.unset(k)
    on_key = {n: len(re.findall(r"Exchange hashpartitioning\(arrangement_key#\d+, ", t)) for n, t in plan.items()}
    assert on_key["fin"] == 0, plan["fin"]
    assert on_key["ccr"] <= 1, plan["ccr"]  # the collateral, summed per arrangement from allocations
    plain = {n: wh.at().read(f"canon.{n}") for n in p.loads}
    from ledgerlens.plans.pipeline import build_reports
    want = build_reports(spark, plain, AS_OF)
    for a, b in ((p.reports.fin_detail.data, want.fin_detail.data), (p.reports.ccr_trade.data, want.ccr_trade.data),
                 (p.reports.rec_detail, want.rec_detail)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert dated_canon(wh, "1900-01-01")["position"].count() == 0


def test_reruns_are_compared_by_digests(spark, tmpdir_path):
    wh = Warehouse(spark, tmpdir_path)
    base = spark.range(5000).selectExpr("concat('k', id) as k", "cast(id as int) as v", "if(id % 7 = 0, null, date'2026-03-31') as as_of_date")
    for run_id, df in (("a", base), ("b", base.repartition(5)), ("c", base.withColumn("v", F.when(F.col("k") == "k17", -1).otherwise(F.col("v")))),
                       ("d", base.where("k <> 'k21'"))):
        run = wh.run(run_id, "v1")
        run.upsert("canon.t", df, ("k", "as_of_date"), snapshot=True)
        run.publish()
    got = {r: check_rerun_runs(wh, "a", r, {"t": ("k", "as_of_date")}).first().violations for r in "abcd"}
    assert got == {"a": 0, "b": 0, "c": 2, "d": 1}
    diff = digests.compare_runs(wh, "a", "c", {"canon.t": ("k",)})["canon.t"]
    assert rows(diff, "k", "v", "side") == [("k17", -1, "only_b"), ("k17", 17, "only_a")]
    leaves = digests.unequal_leaves(*[digests.digest_tree(wh.at(r).read("canon.t"), ["k"], "as_of_date") for r in "ac"])
    assert leaves.count() == 1  # of 512: the rows of one bucket of one date are compared
    assert digests.tree_diff(base.limit(0), base.limit(0), ["k"]).count() == 0


def test_lines_in_are_records_and_rejects(spark, tmpdir_path):
    cols = EXTRACT_COLUMNS["TRD_counterparty"]
    path = os.path.join(tmpdir_path, "TRD_counterparty.csv")
    with open(path, "w") as f:
        f.write("trd_counterparty_id,counterparty_name,lei,country\n")
        f.write('1,"two\nlines",L1,DE\n2,plain,,\n3,surplus,L,FR,more\n4,short\n"5","quoted, ""and"" so",L5,IT\n,no key,L6,ES\n')
    assert rows(read_extract(spark, path, cols), "counterparty_name") == [('no key',), ('plain',), ('quoted, "and" so',), ("two\nlines",)]
    got = read_rejects(spark, path, cols).collect()
    assert sorted(r.line.strip() for r in got) == ["3,surplus,L,FR,more", "4,short"] and all(r.file.endswith(".csv") for r in got)
    assert rows(landing_counts(spark, tmpdir_path, ["TRD_counterparty"])) == [("TRD_counterparty", 6, 4, 2, 1)]


def test_code_lists_with_faults(spark):
    entries = [("A", "x", "2000-01-01", "2010-01-01"), ("A", "y", "2005-01-01", "2006-01-01"), ("A", "z", "2012-01-01", None),
               ("B", "p", "2000-01-01", None), ("B", "q", "2000-01-01", None), ("C", "ok", "1800-01-01", "2500-01-01")]
    codes = spark.createDataFrame(entries, "code string, mapped_value string, valid_from string, valid_to string").withColumns(
        {c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})
    found = X.code_list_findings(codes)
    assert sorted((r.code, r.kind, str(r.valid_from), str(r.valid_to)) for r in found.collect()) == [
        ("A", "GAP", "2010-01-01", "2012-01-01"), ("A", "OVERLAP", "2005-01-01", "2006-01-01"), ("B", "OVERLAP", "2000-01-01", "None")]
    facts = spark.createDataFrame([(i, c, d) for i, (c, d) in enumerate(
        [("A", "2005-06-01"), ("A", "2001-01-01"), ("A", "2011-01-01"), ("A", "2030-01-01"), ("B", "2020-01-01"), ("A", None),
         ("C", "1850-01-01"), ("C", "2400-01-01"), (None, "2001-01-01"), ("A", "1999-12-31")])], "id int, c string, d string").withColumn("d", F.to_date("d"))
    got = X.map_effective_codes(facts, "c", "d", codes)
    assert got.columns == ["id", "c", "d", "mapped_value"]
    assert rows(got, "id", "mapped_value") == list(enumerate(["y", "x", None, "z", "q", None, "ok", "ok", None, None]))
    hit = X.rows_in_findings(facts, "c", "d", found)
    assert rows(hit, "code", "kind", "rows") == [("A", "GAP", 1), ("A", "OVERLAP", 1), ("B", "OVERLAP", 1)]


def test_a_bucketed_write_deals_its_rows_out_once(spark, tmpdir_path, monkeypatch):
    """The exchange of the keys is that of the buckets, quarantined tables are rewritten
    without any, and the greatest row of a key, the dates and the buckets are as before."""
    kind, plans = type(spark.range(1)), []
    write = kind.write
    monkeypatch.setattr(kind, "write", property(lambda self: (
        plans.append(self._jdf.queryExecution().executedPlan().toString()), write.fget(self))[1]))
    keys = ("arrangement_key", "as_of_date")
    df = spark.range(400).selectExpr("concat('a', id % 150) as arrangement_key", "cast(id as int) as v",
                                     "if(id % 2 = 0, date '2026-03-31', date '2026-06-30') as as_of_date")
    run = Warehouse(spark, tmpdir_path, buckets=4).run("one", "v1", "2026-03-31")
    run.upsert("canon.position", df, keys)
    assert [p.count("Exchange") for p in plans] == [1]
    wanted = rows(df.groupBy(*keys).agg(F.max("v").alias("v")), "arrangement_key", "as_of_date", "v")
    assert rows(run.read("canon.position"), "arrangement_key", "as_of_date", "v") == wanted
    plans.clear()
    audit_run(run, [X.QualityRule("Q", "position", "validity", "ERROR", "quarantine", "v % 10 <> 0")])
    assert any("Exchange" not in p and "v" in p and "FileScan" in p for p in plans)
    run.publish()
    good = [w for w in wanted if w[2] % 10]
    assert rows(run.read("canon.position"), "arrangement_key", "as_of_date", "v") == good
    dated = run.read_dated("canon.position", "2026-03-31")
    joined = dated.hint("merge").join(dated.select("arrangement_key", F.col("v").alias("w")), "arrangement_key")
    assert joined.where("v = w").count() == len([w for w in good if str(w[1]) == "2026-03-31"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
    # a second upsert over the same dates: incoming rows win, others survive
    again = run.run("two", "v1", "2026-03-31")
    again.upsert("canon.position", spark.createDataFrame([("a0", -1, "2026-03-31")], "arrangement_key string, v int, as_of_date string")
                 .withColumn("as_of_date", F.to_date("as_of_date")), keys)
    got = rows(again.read("canon.position"), "arrangement_key", "as_of_date", "v")
    rest = lambda of: [w for w in of if (w[0], str(w[1])) != ("a0", "2026-03-31")]
    assert rest(got) == rest(good) and [w[2] for w in got if w not in rest(got)] == [-1]


@pytest.mark.parametrize("name, keys", [("canon.position", ("arrangement_key", "as_of_date")),
                                        ("canon.collateral_allocation", ("collateral_key", "arrangement_key", "as_of_date"))])
def test_a_second_run_computes_and_deals_out_its_rows_once(spark, tmpdir_path, monkeypatch, name, keys):
    """The incoming rows are written by one exchange; the stored rows that survive are found
    in the buckets without any, added to the same folders, and read by bucket again."""
    hashed = "substring(sha2(cast({} as string), 256), 1, 24)".format
    df = spark.range(600).selectExpr(
        f"{hashed('id % 300')} as arrangement_key", f"if(id % 50 = 0, 'c', {hashed('id % 7')}) as collateral_key", "cast(id as int) as v",
        "case when id % 11 = 0 then null when id % 2 = 0 then date '2026-03-31' else date '2026-06-30' end as as_of_date")
    one = Warehouse(spark, tmpdir_path, buckets=4).run("one", "v1")
    one.upsert(name, df, keys)
    one.publish()
    first = rows_of(one.read(name), *keys, "v")
    kind, plans = type(spark.range(1)), []
    write = kind.write
    monkeypatch.setattr(kind, "write", property(lambda self: (
        plans.append(self._jdf.queryExecution().executedPlan().toString()), write.fget(self))[1]))
    monkeypatch.setattr(kind, "persist", lambda self, *a: pytest.fail("rows are held"))
    incoming = df.where("v < 200").withColumn("v", -F.col("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        two = one.run("two", "v1")
        two.upsert(name, incoming, keys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [p.count("Exchange") for p in plans] == [1, 0], plans
    new = rows_of(incoming.groupBy(*keys).agg(F.max("v").alias("v")), *keys, "v")
    taken = {r[:-1] for r in new if r[-2] is not None}
    want = sorted([r for r in first if r[:-1] not in taken] + new, key=str)
    assert sorted(rows_of(two.read(name), *keys, "v"), key=str) == want
    # each date is one folder and known by bucket; the rows without a date stay where they are
    folders = [s[1] for s in two._state(name)["segments"]]
    assert sorted(folders) == ["as_of_date=2026-03-31", "as_of_date=2026-06-30", *["as_of_date=__HIVE_DEFAULT_PARTITION__"] * 2]
    dated = two.read_dated(name, "2026-03-31")
    by = dated.groupBy(*keys[:-1]).agg(F.sum("v").alias("v"))
    assert "Exchange" not in by._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, by.collect())) == sorted((*r[:-2], r[-1]) for r in want if str(r[-2]) == "2026-03-31")
    # another number of buckets: the stored ones are read as any files, with the same result
    two.publish()
    three = Warehouse(spark, tmpdir_path, buckets=3).run("three", "v1")
    three.upsert(name, df.where("v = 2").withColumn("v", F.lit(7000)), keys)
    last = [(*r[:-1], 7000) if r[:-1] == gone else r for gone in [rows_of(df.where("v = 2"), *keys)[0]] for r in want]
    assert sorted(rows_of(three.read(name), *keys, "v"), key=str) == sorted(last, key=str)


def test_a_packed_key_comes_back(spark):
    values = ["", None, "a", "0123456789ab", "12345678901", "abcdef0123456789abcdef01", "ABCDEF0123456789ABCDEF01", "\u00e9" * 12,
              "\x02abc", "\x02\x02", "\x01", "\u00e923456789\u00e9", "0" * 24, "0" * 23 + "g", "0" * 23, "0" * 48]
    df = spark.createDataFrame([(v,) for v in values], "k string").withColumn("p", packed_key("k"))
    got = df.withColumn("back", unpacked_key("p")).collect()
    assert [r.back for r in got] == values and len({r.p and bytes(r.p) for r in got}) == len(values)
    assert [len(r.p) for r in got if r.k and len(r.p) == 12 and len(r.k) != 24] == []


def test_shuffle_files_go_with_the_write_that_made_them(spark, tmpdir_path):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files().mkString(" ")))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting, None), shuffled()
    run = Warehouse(spark, tmpdir_path, buckets=4).run("one", "v1")
    df = spark.range(5000).selectExpr("cast(id as string) as arrangement_key", "date '2026-03-31' as as_of_date")
    with shuffles_released(spark):
        with shuffles_released(spark):
            run.upsert("canon.position", df, ("arrangement_key", "as_of_date"))
        run.upsert("canon.other", df, ("arrangement_key", "as_of_date"))
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(setting, None) == was
    assert run.read("canon.position").count() == run.read("canon.other").count() == 5000
