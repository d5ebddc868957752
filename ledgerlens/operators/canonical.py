"""LD-1..15: source extracts to the canonical model.

A load is a table of exceptions. A target column that is not named takes the column of
the same name from the extract, typed by its type in ``ENTITY_SCHEMAS`` (text as an
upper-case code, dates, money, rates, Y/N flags). Named ones say a kind and their sources.
Expression, declared sources and description of every column follow from its kind, so a
load's DataFrame and its lineage come from one line.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import surrogate_key_sql, try_date_sql
from ledgerlens.plans.mapping import ColumnMapping, Mapping, MappingResult, apply_mapping
from ledgerlens.schemas import ENTITY_SCHEMAS, conform

#: kind -> (expression over the source column ``{0}``, description)
_TYPED = {
    "copy": ("{0}", "direct copy"),
    "code": ("upper(trim({0}))", "code in upper case without surrounding blanks"),
    "text": ("trim({0})", "text without surrounding blanks"),
    "optional": ("nullif(trim({0}), '')", "text, null where blank"),
    "money": ("try_cast(trim({0}) as decimal(20,2))", "amount; null where it does not parse"),
    "rate": ("try_cast(trim({0}) as decimal(9,4))", "rate; null where it does not parse"),
    "flag": ("{0} = 'Y'", "true for Y"),
    "key": (None, "surrogate key of the business key"),
    "key_if_given": (None, "surrogate key, null where the id is blank"),
    "date": (None, "date; null unless a whole valid date"),
    "absent": ("cast(null as string)", "not delivered by this extract"),
    "run_date": ("date '{0}'", "reporting date of the load"),
    "constant": ("'{0}'", "constant of the load"),
}
_KIND_OF_TYPE = {T.StringType(): "code", T.DateType(): "date", T.BooleanType(): "flag",
                 T.DecimalType(20, 2): "money", T.DecimalType(9, 4): "rate"}


def _column(target: str, kind: str, *args: str) -> ColumnMapping:
    """One column from its kind; an argument in quotes is a literal and no source."""
    sources = tuple(a for a in args if not a.startswith("'"))
    pattern, text = _TYPED[kind]
    if kind in ("run_date", "constant"):
        return ColumnMapping(target, pattern.format(*args), (), text)
    if kind == "date":
        expression = try_date_sql(args[0])
    elif kind in ("key", "key_if_given"):
        expression = surrogate_key_sql(*args)
        if kind == "key_if_given":
            expression = f"if(coalesce(trim({args[-1]}), '') = '', null, {expression})"
    else:
        expression = pattern.format(*args)
    return ColumnMapping(target, expression, sources, text)


@dataclass(frozen=True)
class LoadSpec:
    """``named``: target -> (kind, *sources) or a ready ``ColumnMapping``."""

    rule_id: str
    entity: str
    extract: str
    named: dict = field(default_factory=dict)
    where: str | None = None

    def mapping(self, as_of: str) -> Mapping:
        columns = []
        for f in ENTITY_SCHEMAS[self.entity].fields:
            spec = self.named.get(f.name)
            if isinstance(spec, ColumnMapping):
                columns.append(spec)
            elif spec:
                columns.append(_column(f.name, *spec))
            elif f.name == "as_of_date":
                columns.append(_column(f.name, "run_date", as_of))
            else:
                columns.append(_column(f.name, _KIND_OF_TYPE[f.dataType], f.name))
        system, name = self.extract.split("_", 1)
        return Mapping(self.rule_id, "CANONICAL", self.entity, "SOURCE",
                       f"{system.upper()}_{name}", tuple(columns), where=self.where)


def _identity(prefix: str, system: str, id_col: str, *key: str) -> dict:
    """Key, source system and source id of an entity that one system owns."""
    return {f"{prefix}_key": ("key", *(key or (id_col,))),
            f"{prefix}_source_system": ("constant", system),
            f"{prefix}_source_id": ("copy", id_col)}


_RESOLVED = "party that the identity cross-reference gives for the external id"
_DATED = {"as_of_date": ("date", "as_of_date")}


def _role(system: str, id_col: str, external: str, role: ColumnMapping | tuple) -> dict:
    return {"arrangement_key": ("key", f"'{system}'", id_col),
            "party_key": ColumnMapping("party_key", "party_key", (external,), _RESOLVED),
            "role_type": role}


_BORROWER_OR_DEPOSITOR = ColumnMapping(
    "role_type", "if(upper(product_family) = 'LOAN', 'BORROWER', 'DEPOSITOR')",
    ("product_family",), "borrower of a loan, else depositor")
_ASSESSED = ColumnMapping(
    "arrangement_key",
    f"if(source_system = 'REF', {surrogate_key_sql('contract_ref')}, "
    f"{surrogate_key_sql('source_system', 'contract_ref')})",
    ("source_system", "contract_ref"),
    "surrogate key of the party for party-level assessments, else of the arrangement")

#: Every load, in dependency order. Rule ids and business keys are fixed values.
LOADS = (
    LoadSpec("LD-PARTY-001", "party", "ref_party", {
        **_identity("party", "REF", "src_party_id"), "legal_name": ("text", "legal_name"),
        "lei": ("optional", "lei"), "country_of_incorporation": ("code", "country"),
        "source_sector_code": ("code", "sector_code")}),
    LoadSpec("LD-PARTYHIER-001", "party_hierarchy", "ref_party_hierarchy", {
        "child_party_key": ("key", "child_src_party_id"),
        "parent_party_key": ("key", "parent_src_party_id")}),
    LoadSpec("LD-INSTR-001", "instrument", "ref_instrument", {
        **_identity("instrument", "REF", "src_instrument_id"), "isin": ("optional", "isin"),
        "issuer_party_key": ("key", "issuer_src_party_id")}),
    LoadSpec("LD-ARR-CBS-001", "arrangement", "cbs_account", {
        **_identity("arrangement", "CBS", "account_id", "'CBS'", "account_id"),
        "inception_date": ("date", "open_date"), "original_notional": ("money", "original_principal"),
        "booking_entity_party_key": ("absent",), "instrument_key": ("absent",),
        "netting_set_key": ("absent",)}),
    LoadSpec("LD-ARR-TRD-001", "arrangement", "trd_trade", {
        **_identity("arrangement", "TRD", "trade_id", "'TRD'", "trade_id"),
        "product_family": ("constant", "DERIVATIVE"), "inception_date": ("date", "trade_date"),
        "original_notional": ("money", "notional"), "booking_entity_party_key": ("absent",),
        "instrument_key": ("key_if_given", "src_instrument_id"),
        "netting_set_key": ("key_if_given", "netting_agreement_id")}),
    LoadSpec("LD-APR-CBS-001", "arrangement_party_role", "cbs_account",
             _role("CBS", "account_id", "cbs_customer_id", _BORROWER_OR_DEPOSITOR),
             where="party_key is not null"),
    LoadSpec("LD-APR-TRD-001", "arrangement_party_role", "trd_trade",
             _role("TRD", "trade_id", "trd_counterparty_id", ("constant", "COUNTERPARTY")),
             where="party_key is not null"),
    LoadSpec("LD-NETSET-001", "netting_set", "trd_netting_agreement", {
        **_identity("netting_set", "TRD", "netting_agreement_id"),
        "counterparty_party_key": ColumnMapping(
            "counterparty_party_key", "party_key", ("trd_counterparty_id",), _RESOLVED)}),
    LoadSpec("LD-EVENT-001", "trade_event", "trd_event", {
        **_identity("event", "TRD", "event_id"),
        "arrangement_key": ("key", "'TRD'", "trade_id")}),
    LoadSpec("LD-POS-001", "position", "fin_position", {
        **_DATED, "arrangement_key": ("key", "source_system", "contract_ref")}),
    LoadSpec("LD-CLASS-001", "classification", "fin_classification", {
        **_DATED, "arrangement_key": _ASSESSED}),
    LoadSpec("LD-COL-001", "collateral", "col_collateral",
             _identity("collateral", "COL", "collateral_id")),
    *(LoadSpec(rule, "collateral_allocation", "col_allocation", {
        **_DATED, "collateral_key": ("key", "collateral_id"),
        "arrangement_key": ("key", f"'{system}'", "contract_ref")})
      for rule, system in (("LD-COLALLOC-001", "TRD"), ("LD-COLALLOC-002", "CBS"))),
)


@dataclass
class Load:
    """One canonical entity produced by one or more mappings."""

    entity: str
    parts: list[MappingResult]

    @property
    def data(self) -> DataFrame:
        out = None
        for p in self.parts:
            part = conform(p.data, ENTITY_SCHEMAS[self.entity])
            out = part if out is None else out.unionByName(part)
        return out

    @property
    def mappings(self) -> list[Mapping]:
        return [p.mapping for p in self.parts]


def _relations(x: dict[str, DataFrame], xref: DataFrame) -> dict[str, DataFrame]:
    """The relation each load reads where it is not the extract alone, by rule id."""
    def resolved(extract: str, system: str, id_col: str, how: str) -> DataFrame:
        known = xref.where(F.col("source_system") == system).select(
            F.col("source_id").alias(id_col), "party_key")
        return x[extract].join(known, id_col, how)

    def allocated(extract: str, id_col: str) -> DataFrame:
        """Allocations to contracts of one system; ids are unique, so a semi-join."""
        return x["col_allocation"].join(
            x[extract].select(F.col(id_col).alias("contract_ref")), "contract_ref", "left_semi")

    return {
        "LD-APR-CBS-001": resolved("cbs_account", "CBS", "cbs_customer_id", "inner"),
        "LD-APR-TRD-001": resolved("trd_trade", "TRD", "trd_counterparty_id", "inner"),
        "LD-NETSET-001": resolved("trd_netting_agreement", "TRD", "trd_counterparty_id", "left"),
        "LD-COLALLOC-001": allocated("trd_trade", "trade_id"),
        "LD-COLALLOC-002": allocated("cbs_account", "account_id"),
    }


def load_all(spark: SparkSession, x: dict[str, DataFrame], xref: DataFrame,
             as_of: str) -> dict[str, Load]:
    """Every canonical load in dependency order (lazy DataFrames)."""
    relations, out = _relations(x, xref), {}
    for spec in LOADS:
        done = apply_mapping(spark, spec.mapping(as_of), relations.get(spec.rule_id, x[spec.extract]))
        out.setdefault(spec.entity, Load(spec.entity, [])).parts.append(done)
    return out
