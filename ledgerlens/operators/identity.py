"""IDR-1..8: party identity resolution across source systems.

Order of strength: LEI, then normalised (name, country) where the external
record has no LEI, else unresolved (kept, visibly, with a null key). The
reference master resolves to itself (NATIVE).

Plan shape, chosen for scale: the reference side is first *aggregated per
match key* (``groupBy(lei)`` and ``groupBy(norm_name, country)``: count of
candidate parties and the smallest party key). Externals then meet each index
with one N:1 left join, and a CASE picks the strongest method. No anti-join
chain, no pair enumeration: a hot name shared by a third of all records is a
partially aggregated group on the index side and a skewed-but-N:1 probe on
the external side (AQE splits it). The two probes take disjoint records.

Ambiguity (ledger Q7): when a key matches several reference parties, the
reference emits one row per candidate, so one source id reaches several
parties, which its own functional test (IDR-8) forbids, and at scale the pair
count is quadratic. Here such an id gets one row, method ``AMBIGUOUS``, null
party key and its ``candidate_count``; the candidates themselves are listed by
:func:`ambiguous_candidates`, one row per reference party, so the full
relation is recoverable without ever materialising pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import blank_to_null, norm_upper, surrogate_key

# Resolution methods.
LEI, NAME_COUNTRY, UNRESOLVED, NATIVE, AMBIGUOUS = (
    "LEI", "NAME_COUNTRY", "UNRESOLVED", "NATIVE", "AMBIGUOUS")


def reference_side(ref_party: DataFrame) -> DataFrame:
    """IDR-1: hashed key, trimmed LEI (empty -> null), normalised name and country."""
    return ref_party.select(
        F.col("src_party_id"),
        surrogate_key("src_party_id").alias("party_key"),
        blank_to_null("lei").alias("lei"),
        norm_upper("legal_name").alias("norm_name"),
        norm_upper("country").alias("country"),
    )


def external_side(cbs_customer: DataFrame, trd_counterparty: DataFrame) -> DataFrame:
    """IDR-2: both systems' customer records, tagged with their system."""
    cbs = cbs_customer.select(
        F.lit("CBS").alias("source_system"), F.col("cbs_customer_id").alias("source_id"),
        blank_to_null("lei").alias("lei"), norm_upper("customer_name").alias("norm_name"),
        norm_upper("country").alias("country"))
    trd = trd_counterparty.select(
        F.lit("TRD").alias("source_system"), F.col("trd_counterparty_id").alias("source_id"),
        blank_to_null("lei").alias("lei"), norm_upper("counterparty_name").alias("norm_name"),
        norm_upper("country").alias("country"))
    return cbs.unionByName(trd)


def _index(ref: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    not_null = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        not_null = not_null & F.col(k).isNotNull()
    return (ref.where(not_null)
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias(f"{prefix}_candidates"),
                 F.min("party_key").alias(f"{prefix}_party_key")))


def resolve_party_identity(ref_party: DataFrame, cbs_customer: DataFrame,
                           trd_counterparty: DataFrame) -> DataFrame:
    """IDR-3..6: the cross-reference ``(source_system, source_id, party_key,
    resolution_method, candidate_count)``, one row per source record."""
    ref = reference_side(ref_party)
    ext = external_side(cbs_customer, trd_counterparty)
    by_lei = _index(ref, ["lei"], "lei")
    by_name = _index(ref, ["norm_name", "country"], "name")
    # records with an LEI probe the LEI index only, those without the name index only:
    # no null LEI meets another in one task, and only the latter are dealt by name
    given, bare = ext.where(F.col("lei").isNotNull()), ext.where(F.col("lei").isNull())
    none = F.lit(None).cast("long")
    x = (given.join(by_lei, on="lei", how="left")
              .withColumns({"name_candidates": none, "name_party_key": none.cast("string")})
              .unionByName(bare.join(by_name, on=["norm_name", "country"], how="left")
                               .withColumns({"lei_candidates": none, "lei_party_key": none.cast("string")})))
    lei_n = F.coalesce(F.col("lei_candidates"), F.lit(0))
    name_n = F.coalesce(F.col("name_candidates"), F.lit(0))
    method = (F.when(lei_n == 1, F.lit(LEI))
               .when(lei_n > 1, F.lit(AMBIGUOUS))
               .when(name_n == 1, F.lit(NAME_COUNTRY))
               .when(name_n > 1, F.lit(AMBIGUOUS))
               .otherwise(F.lit(UNRESOLVED)))
    party_key = (F.when(lei_n == 1, F.col("lei_party_key"))
                  .when((lei_n == 0) & (name_n == 1), F.col("name_party_key")))
    candidates = F.when(lei_n > 0, lei_n).otherwise(name_n).cast("long")
    externals = x.select("source_system", "source_id", party_key.alias("party_key"),
                         method.alias("resolution_method"), candidates.alias("candidate_count"))
    native = ref.select(F.lit("REF").alias("source_system"),
                        F.col("src_party_id").alias("source_id"), "party_key",
                        F.lit(NATIVE).alias("resolution_method"),
                        F.lit(1).cast("long").alias("candidate_count"))
    return externals.unionByName(native)


def method_mix(xref: DataFrame) -> DataFrame:
    """IDR-7: parties per resolution method, largest first."""
    return (xref.groupBy("resolution_method")
                .agg(F.count(F.lit(1)).alias("parties"))
                .orderBy(F.desc("parties"), F.asc("resolution_method")))


def ambiguous_matches(xref: DataFrame) -> DataFrame:
    """Ambiguity report: source records whose key matched several parties."""
    return xref.where(F.col("resolution_method") == AMBIGUOUS) \
               .select("source_system", "source_id", "candidate_count")


def ambiguity_effect(xref: DataFrame, contracts: DataFrame) -> DataFrame:
    """What ambiguity costs: contracts ``(source_system, source_id, amount)`` and their
    amounts, by the way their party was resolved; the unresolved ones have no party."""
    return (contracts.join(xref.select("source_system", "source_id", "resolution_method"), ["source_system", "source_id"], "left")
            .groupBy("source_system", F.coalesce("resolution_method", F.lit(UNRESOLVED)).alias("resolution_method"))
            .agg(F.count(F.lit(1)).alias("arrangements"), F.sum("amount").cast("decimal(38,2)").alias("amount")))


def ambiguous_candidates(ref_party: DataFrame, cbs_customer: DataFrame,
                         trd_counterparty: DataFrame) -> DataFrame:
    """The candidate parties behind ambiguous matches, one row per (key, party).

    Linear in the reference side: each reference party appears once per match
    key it shares with another party, and only if some unresolved-by-LEI
    external record probes that key. ``external_records`` counts the probes.
    """
    ref = reference_side(ref_party)
    ext = external_side(cbs_customer, trd_counterparty)
    lei_keys = _index(ref, ["lei"], "k").where("k_candidates > 1")
    name_keys = _index(ref, ["norm_name", "country"], "k").where("k_candidates > 1")
    ext_lei = ext.where(F.col("lei").isNotNull()).groupBy("lei") \
                 .agg(F.count(F.lit(1)).alias("external_records"))
    ext_name = ext.where(F.col("lei").isNull()).groupBy("norm_name", "country") \
                  .agg(F.count(F.lit(1)).alias("external_records"))
    by_lei = (ref.join(lei_keys.select("lei"), "lei", "left_semi")
                 .join(ext_lei, "lei")
                 .select(F.lit(LEI).alias("match_basis"), F.col("lei").alias("match_key"),
                         "party_key", "external_records"))
    by_name = (ref.join(name_keys.select("norm_name", "country"), ["norm_name", "country"],
                        "left_semi")
                  .join(ext_name, ["norm_name", "country"])
                  .select(F.lit(NAME_COUNTRY).alias("match_basis"),
                          F.concat_ws(" | ", "norm_name", "country").alias("match_key"),
                          "party_key", "external_records"))
    return by_lei.unionByName(by_name)


def check_functional(xref: DataFrame) -> DataFrame:
    """IDR-8: source ids that reach more than one party key (must be empty)."""
    return (xref.where(F.col("party_key").isNotNull())
                .groupBy("source_system", "source_id")
                .agg(F.countDistinct("party_key").alias("party_keys"))
                .where(F.col("party_keys") > 1))
