"""The corpus pipeline, stage by stage, against the operators' own answers."""

import __spark_entry__ as E
import corpus_pipeline
from ledgerlens.llm import jaccard, quality, secrets
from ledgerlens.llm.shared import stored, table
from tests.conftest import SF_SMALL
from tests.llm.test_tokens import check_packing


def test_registered():
    names = list(E.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_SMALL), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    ids = lambda df: {r.doc_id for r in df.collect()}
    before, after = seen["language"]
    assert len(ids(after)) >= 0.98 * len(ids(before))
    before, after = seen["quality"]
    assert ids(after) == {r.doc_id for r in quality.quality_rules(before, table(spark, SF_SMALL, "labels")).collect() if r.kept}
    before, after = seen["near_duplicates"]
    assert ids(after) == {r.component_id for r in jaccard.linked(before).collect()}
    before, after = seen["secrets"]
    assert ids(after) == ids(before)
    left = [r for r in secrets.secret_digests(after).collect() if r.n_assign + r.n_access + r.n_hex]
    assert not left
    before, after = seen["packing"]
    check_packing(before.collect(), after.collect())


def test_run_chains_the_stages(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [
        ("one", lambda s, docs, sf: docs.where("doc_id < 50")), ("two", lambda s, docs, sf: docs.where("doc_id >= 40"))])
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == list(range(40, 50))


def test_clashing_and_empty_tables(spark):
    docs = table(spark, SF_SMALL, "documents").selectExpr("*", "1 AS key", "2 AS row", "3 AS words", "4 AS spans", "5 AS kept", "6 AS kinds")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs.where("doc_id < 30"), SF_SMALL)
        assert out.columns == docs.columns and out.count() > 0
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
