"""SRC-1/2 (CSV landing zone), SNK-6 (findings as JSON), and the CSV path end to end."""

import json
import os

from ledgerlens.operators import audit as A
from ledgerlens.plans.pipeline import build_pipeline
from ledgerlens.plans.warehouse import write_findings_json
from ledgerlens.sources.extracts import EXTRACT_COLUMNS, read_extract, register_extracts
from ledgerlens.sources.testdata import AS_OF
from ledgerlens.sources.testdata import testdata_extracts as extracts_of
from tests.conftest import SF_SMALL, rows


def test_csv_extract_reading(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "REF_party.csv")
    with open(path, "w") as f:
        f.write("src_party_id,legal_name,lei,country,sector_code,is_financial_institution,"
                "is_group_entity\n")
        f.write('P1,"Alpha ""Bank"", plc",,DE,BANK,Y,N\n')
        f.write('P2,"",LEI2,"",X,N,\n')
    df = read_extract(spark, path, EXTRACT_COLUMNS["REF_party"])
    got = rows(df, "src_party_id", "legal_name", "lei", "country", "is_group_entity")
    assert got == [("P1", 'Alpha "Bank", plc', None, "DE", "N"), ("P2", None, "LEI2", None, None)]
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)


def test_csv_landing_zone_gives_the_same_build(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    x = extracts_of(spark, SF_SMALL)
    for name, cols in EXTRACT_COLUMNS.items():
        (x[name.lower()].select(*cols).write.option("header", True).option("escape", '"')
         .csv(os.path.join(landing, f"{name}.csv")))
    from_csv = build_pipeline(spark, register_extracts(spark, landing), AS_OF)
    from_parquet = build_pipeline(spark, x, AS_OF)
    for table in ("finrep_assets_by_sector", "ccr_exposure_by_netting_set",
                  "lens_population_reconciliation"):
        a = from_csv.reports.tables()[table]
        b = from_parquet.reports.tables()[table]
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table


def test_findings_written_as_json(spark, small_pipeline, tmpdir_path):
    from ledgerlens.schemas import ENTITY_SCHEMAS, registry_frame
    from ledgerlens.sources.catalog import catalog_from_schemas
    cat = catalog_from_schemas(spark, {"CANONICAL": ENTITY_SCHEMAS,
                                       "REPORTING": small_pipeline.reports.tables()})
    f = A.run_audit(registry_frame(spark), cat, small_pipeline.lineage())
    out = os.path.join(tmpdir_path, "findings")
    write_findings_json(f, out)
    lines = [json.loads(l) for p in sorted(os.listdir(out)) if p.endswith(".json")
             for l in open(os.path.join(out, p))]
    assert lines == [{"rule_id": "DP-29", "severity": "WARN", "subject": "canon.trade_event",
                      "message": "has no as_of_date, so a past day cannot be rebuilt"}]
