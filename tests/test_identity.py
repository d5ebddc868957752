from ledgerlens.functions import surrogate_key
from ledgerlens.operators import identity
from tests.conftest import rows

REF = [("P1", "Alpha Bank", "LEI000000000000000001", "DE"),
       ("P2", "Beta Corp", "", "FR"),
       ("P3", "Gamma Ltd", "LEI000000000000000003", "GB"),
       ("P4", "Twin Holdings", None, "NL"),
       ("P5", "Twin Holdings", None, "NL"),
       ("P6", "Delta SA", "LEI000000000000000006", "ES")]
CBS = [("C1", "alpha bank", " LEI000000000000000001 ", "de", None),      # LEI with padding
       ("C2", "  beta corp ", None, "fr", None),                          # name/country, other case
       ("C3", "Nobody Inc", None, "IT", None),                            # no LEI, no match
       ("C4", "Gamma Ltd", "LEI999999999999999999", "GB", None),          # unknown LEI, name matches
       ("C5", "twin holdings", "", "nl", None)]                           # ambiguous weak match
TRD = [("T1", "DELTA SA", "LEI000000000000000006", "ES"),
       ("T2", "BETA CORP", None, "FR")]


def _frames(spark):
    ref = spark.createDataFrame(REF, "src_party_id string, legal_name string, lei string, country string")
    cbs = spark.createDataFrame(CBS, "cbs_customer_id string, customer_name string, lei string, "
                                     "country string, src_party_id_hint string")
    trd = spark.createDataFrame(TRD, "trd_counterparty_id string, counterparty_name string, "
                                     "lei string, country string")
    return ref, cbs, trd


def test_resolution_methods(spark):
    ref, cbs, trd = _frames(spark)
    xref = identity.resolve_party_identity(ref, cbs, trd)
    got = {(r.source_system, r.source_id): (r.resolution_method, r.candidate_count)
           for r in xref.collect()}
    assert got[("CBS", "C1")] == ("LEI", 1)
    assert got[("CBS", "C2")] == ("NAME_COUNTRY", 1)
    assert got[("CBS", "C3")] == ("UNRESOLVED", 0)
    assert got[("CBS", "C4")] == ("UNRESOLVED", 0)   # an LEI unknown to the master never falls to name
    assert got[("CBS", "C5")] == ("AMBIGUOUS", 2)
    assert got[("TRD", "T1")] == ("LEI", 1)
    assert got[("TRD", "T2")] == ("NAME_COUNTRY", 1)
    assert sum(1 for k in got if k[0] == "REF") == 6
    keys = {(r.source_system, r.source_id): r.party_key for r in xref.collect()}
    p1 = spark.createDataFrame([("P1",), ("P2",)], "id string") \
              .select(surrogate_key("id").alias("k")).collect()
    assert keys[("CBS", "C1")] == p1[0].k
    assert keys[("TRD", "T2")] == p1[1].k
    assert keys[("CBS", "C5")] is None and keys[("CBS", "C3")] is None


def test_one_row_per_source_record_and_functional(spark):
    ref, cbs, trd = _frames(spark)
    xref = identity.resolve_party_identity(ref, cbs, trd)
    assert xref.count() == len(REF) + len(CBS) + len(TRD)
    assert identity.check_functional(xref).count() == 0


def test_method_mix_and_ambiguity_report(spark):
    ref, cbs, trd = _frames(spark)
    xref = identity.resolve_party_identity(ref, cbs, trd)
    mix = {r.resolution_method: r.parties for r in identity.method_mix(xref).collect()}
    assert mix == {"NATIVE": 6, "LEI": 2, "NAME_COUNTRY": 2, "UNRESOLVED": 2, "AMBIGUOUS": 1}
    cand = identity.ambiguous_candidates(ref, cbs, trd)
    assert rows(cand, "match_basis", "match_key", "external_records") == \
        [("NAME_COUNTRY", "TWIN HOLDINGS | NL", 1)] * 2
