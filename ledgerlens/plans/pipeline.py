"""The whole build as one lazy graph, and a runner that materialises it.

``build_pipeline`` returns lazy DataFrames for every stage; nothing runs until
a result is written or collected, so a query that needs only part of the graph
plans only that part. ``run_pipeline`` writes the canonical model and the
reports to a :class:`~ledgerlens.plans.warehouse.Warehouse` in dependency
order; reading the written canonical tables back cuts lineage between the
load stage and the reporting stage, so a lost executor reruns one stage, not
the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import canonical, finance, identity, reconcile, risk
from ledgerlens.operators.canonical import Load
from ledgerlens.operators.extensions import QualityRule
from ledgerlens.operators.provenance import Sources
from ledgerlens.plans.mapping import Mapping, MappingResult, lineage_frame
from ledgerlens.plans.publication import audit_run, publish_audited
from ledgerlens.plans.warehouse import Warehouse
from ledgerlens.schemas import ENTITY_SCHEMAS, PRIMARY_KEYS, conform
from ledgerlens.session import shuffles_released
from ledgerlens.sources.extracts import EXTRACT_COLUMNS


@dataclass
class Reports:
    fin_detail: MappingResult
    fin_by_sector: MappingResult
    ccr_trade: MappingResult
    ccr_netting_set: MappingResult
    rec_detail: DataFrame
    rec_population: MappingResult
    rec_netting: MappingResult
    rec_disagreement: MappingResult

    def results(self) -> list[MappingResult]:
        return [self.fin_detail, self.fin_by_sector, self.ccr_trade, self.ccr_netting_set,
                self.rec_population, self.rec_netting, self.rec_disagreement]

    def tables(self) -> dict[str, DataFrame]:
        return {r.mapping.target_table: r.data for r in self.results()}


@dataclass
class Pipeline:
    spark: SparkSession
    as_of: str
    extracts: dict[str, DataFrame]
    xref: DataFrame
    loads: dict[str, Load]
    canon: dict[str, DataFrame]
    reports: Reports | None = None
    extra_mappings: list[Mapping] = field(default_factory=list)
    written_load_log: DataFrame | None = None

    def mappings(self) -> list[Mapping]:
        out = [m for ld in self.loads.values() for m in ld.mappings]
        if self.reports is not None:
            out += [r.mapping for r in self.reports.results()]
        return out + self.extra_mappings

    def lineage(self) -> DataFrame:
        return lineage_frame(self.spark, self.mappings())


def build_reports(spark: SparkSession, canon: dict[str, DataFrame], as_of: str) -> Reports:
    fin_detail = finance.asset_detail(spark, canon, as_of)
    fin_agg = finance.assets_by_sector(spark, fin_detail.data)
    trades = risk.trade_exposure(spark, canon, as_of)
    sets = risk.netting_set_exposure(spark, trades.data)
    rec_detail = reconcile.population_detail(fin_detail.data, trades.data, canon["arrangement"],
                                             canon["trade_event"], as_of, canon.get("inception_dates"))
    return Reports(
        fin_detail=fin_detail, fin_by_sector=fin_agg, ccr_trade=trades, ccr_netting_set=sets,
        rec_detail=rec_detail,
        rec_population=reconcile.population_reconciliation(spark, rec_detail, as_of),
        rec_netting=reconcile.netting_reconciliation(spark, sets.data, as_of),
        rec_disagreement=reconcile.sector_disagreement(spark, canon, as_of),
    )


def build_pipeline(spark: SparkSession, extracts: dict[str, DataFrame], as_of: str,
                   with_reports: bool = True) -> Pipeline:
    """Every stage as a lazy DataFrame."""
    xref = identity.resolve_party_identity(extracts["ref_party"], extracts["cbs_customer"],
                                           extracts["trd_counterparty"])
    loads = canonical.load_all(spark, extracts, xref, as_of)
    canon = {name: ld.data for name, ld in loads.items()}
    p = Pipeline(spark, as_of, extracts, xref, loads, canon)
    if with_reports:
        p.reports = build_reports(spark, canon, as_of)
    return p


def mappings_on_schemas(spark: SparkSession, as_of: str) -> tuple[list[MappingResult], Sources]:
    """Every load and report over empty views of its sources, each apart from the rest, and
    the views: what :func:`~ledgerlens.operators.provenance.source_findings` compares."""
    sources = Sources(spark)
    text = lambda columns: ", ".join(f"{c} string" for c in columns)
    extracts = {n.lower(): sources.add(n, text(c)) for n, c in EXTRACT_COLUMNS.items()}
    xref = sources.add("stg.party_xref", identity.resolve_party_identity(
        extracts["ref_party"], extracts["cbs_customer"], extracts["trd_counterparty"]).schema)
    results = [p for ld in canonical.load_all(spark, extracts, xref, as_of).values() for p in ld.parts]
    canon = {n: sources.add(f"canon.{n}", schema) for n, schema in ENTITY_SCHEMAS.items()}
    on = lambda r: sources.add(r.mapping.target, r.data.schema)
    fin, trades = finance.asset_detail(spark, canon, as_of), risk.trade_exposure(spark, canon, as_of)
    fin_rows, trade_rows = on(fin), on(trades)
    sets = risk.netting_set_exposure(spark, trade_rows)
    rec = reconcile.population_detail(fin_rows, trade_rows, canon["arrangement"], canon["trade_event"], as_of)
    return results + [fin, trades, sets, finance.assets_by_sector(spark, fin_rows),
                      reconcile.population_reconciliation(spark, rec, as_of),
                      reconcile.netting_reconciliation(spark, on(sets), as_of),
                      reconcile.sector_disagreement(spark, canon, as_of)], sources


def load_run(spark: SparkSession, extracts: dict[str, DataFrame], as_of: str, run: Warehouse, parallelism: int = 8,
             lap: Callable[[str], None] = lambda name: None) -> tuple[dict[str, Load], dict[str, int]]:
    """Write the cross-reference and the canonical layer into ``run``; the loads and the
    rows written per mapping. The shuffle files of a table are deleted once it is written."""
    from concurrent.futures import ThreadPoolExecutor

    counts: dict[str, int] = {}

    def write_entity(item):
        name, ld = item
        return run.write_mappings(
            [(part.mapping, conform(part.data, ENTITY_SCHEMAS[name])) for part in ld.parts],
            keys=PRIMARY_KEYS[name],
            partition_col="as_of_date" if "as_of_date" in ENTITY_SCHEMAS[name].names else None)

    # entities that do not need the identity cross-reference start at once,
    # next to the cross-reference job; the two that join it follow
    needs_xref = ("arrangement_party_role", "netting_set")
    xref = identity.resolve_party_identity(extracts["ref_party"], extracts["cbs_customer"],
                                           extracts["trd_counterparty"])
    lazy = canonical.load_all(spark, extracts, xref, as_of)
    with shuffles_released(spark), ThreadPoolExecutor(parallelism) as pool:
        early = [pool.submit(write_entity, (n, ld)) for n, ld in lazy.items()
                 if n not in needs_xref]
        run.replace("stg.party_xref", xref)
        lap("identity")
        loads = canonical.load_all(spark, extracts, run.read("stg.party_xref"), as_of)
        late = [pool.submit(write_entity, (n, loads[n])) for n in needs_xref]
        for f in early + late:
            counts.update(f.result())
    return loads, counts


def run_pipeline(spark: SparkSession, extracts: dict[str, DataFrame], as_of: str,
                 warehouse: Warehouse, parallelism: int = 8,
                 timings: dict[str, float] | None = None, run_id: str | None = None,
                 code_version: str = "unversioned", rules: list[QualityRule] | None = None) -> dict[str, int]:
    """Materialise the build as one run and return rows written per mapping.

    Everything is staged and published at the end by one manifest, so readers see the run
    whole or not at all. Before the reports are built, ``rules`` are evaluated on the
    canonical rows just written: quarantined rows go to ``quar`` tables, and a failing
    ``block`` rule raises :class:`~ledgerlens.plans.publication.Blocked` with nothing
    published but its evidence.

    Stage 1 writes the identity cross-reference while the nine canonical
    entities that do not depend on it are already being written; stage 2 writes
    the two that join it (each entity once: its mappings unioned, keyed upsert
    by date partition). Stage 3
    builds the detail reports from the *written* canonical tables, stage 4 the
    aggregates from the written details. Every write counts its rows per
    mapping with an observation in the same job, and each stage ends with one
    lineage upsert and one load-log upsert for all of its mappings (data
    first, then its lineage and log: ledger Q15). Independent writes of a stage
    run as concurrent Spark jobs.
    """
    import time
    import uuid
    from concurrent.futures import ThreadPoolExecutor

    warehouse = warehouse.run(run_id or f"run-{uuid.uuid4().hex}", code_version, as_of)
    counts: dict[str, int] = {}
    timings = {} if timings is None else timings
    clock = [time.time()]

    def lap(name: str) -> None:
        now = time.time()
        timings[name] = round(now - clock[0], 3)
        clock[0] = now

    loads, loaded = load_run(spark, extracts, as_of, warehouse, parallelism, lap)
    counts.update(loaded)
    if blocked := audit_run(warehouse, rules or []):
        publish_audited(warehouse, blocked)
    # both lenses read the first dates; events are aggregated for them once
    warehouse.replace("stg.inception_dates", finance.inception_dates(warehouse.read("canon.trade_event")))
    lap("canonical")

    canon = dated_canon(warehouse, as_of)
    details = [finance.asset_detail(spark, canon, as_of),
               risk.trade_exposure(spark, canon, as_of),
               reconcile.sector_disagreement(spark, canon, as_of)]
    with ThreadPoolExecutor(parallelism) as pool:
        for got in pool.map(lambda r: warehouse.write_mappings([(r.mapping, r.data)]), details):
            counts.update(got)
    lap("details")
    fin_detail = warehouse.read("rpt.finrep_asset_detail")
    trades = warehouse.read("rpt.ccr_trade_exposure")
    sets = risk.netting_set_exposure(spark, trades)
    rec_detail = reconcile.population_detail(fin_detail, trades, canon["arrangement"],
                                             canon["trade_event"], as_of, canon["inception_dates"])
    aggregates = [finance.assets_by_sector(spark, fin_detail), sets,
                  reconcile.population_reconciliation(spark, rec_detail, as_of)]
    with ThreadPoolExecutor(parallelism) as pool:
        for got in pool.map(lambda r: warehouse.write_mappings([(r.mapping, r.data)]),
                            aggregates):
            counts.update(got)
    netting = reconcile.netting_reconciliation(
        spark, warehouse.read("rpt.ccr_exposure_by_netting_set"), as_of)
    counts.update(warehouse.write_mappings([(netting.mapping, netting.data)]))
    lap("aggregates")
    warehouse.record([m for ld in loads.values() for m in ld.mappings] +
                     [r.mapping for r in details + aggregates + [netting]], counts, as_of)
    warehouse.publish()
    lap("lineage_and_log")
    return counts


def dated_canon(warehouse: Warehouse, as_of: str) -> dict[str, DataFrame]:
    """The canonical tables as the reports of one date read them: that date of the dated
    ones, bucketed on the arrangement where the table is, and the first dates of events."""
    canon = {name: warehouse.read_dated(f"canon.{name}", as_of) for name in ENTITY_SCHEMAS}
    if warehouse.exists("stg.inception_dates"):
        canon["inception_dates"] = warehouse.read_dated("stg.inception_dates", as_of)
    return canon


def pipeline_from_warehouse(spark: SparkSession, extracts: dict[str, DataFrame], as_of: str,
                            warehouse: Warehouse) -> Pipeline:
    """A :class:`Pipeline` whose canonical layer is read back from a built
    warehouse; reports are lazy plans over those Parquet tables."""
    p = build_pipeline(spark, extracts, as_of, with_reports=False)
    warehouse = warehouse.at()  # one run, whatever is published meanwhile
    p.xref = warehouse.read("stg.party_xref")
    p.canon = {name: warehouse.read(f"canon.{name}") for name in p.loads}
    p.reports = build_reports(spark, dated_canon(warehouse, as_of), as_of)
    p.written_load_log = (warehouse.load_log()
                          .where(F.col("target").startswith("canon."))
                          .where(F.col("as_of_date") == F.lit(as_of).cast("date")))
    return p


def load_log_frame(p: Pipeline) -> DataFrame:
    """SNK-4 as a query: rows each load mapping writes for the run date.

    One aggregate per mapping, unioned into a single job; the counts are the
    rows the mapping produced (ledger Q2), not the target's total size.
    """
    if p.written_load_log is not None:
        return p.written_load_log.select("rule_id", "target", "as_of_date", "rows_loaded")
    frames = []
    for name, ld in p.loads.items():
        for part in ld.parts:
            m = part.mapping
            frames.append(conform(part.data, ENTITY_SCHEMAS[name])
                          .agg(F.count(F.lit(1)).alias("rows_loaded"))
                          .select(F.lit(m.rule_id).alias("rule_id"),
                                  F.lit(m.target).alias("target"),
                                  F.lit(p.as_of).cast("date").alias("as_of_date"),
                                  "rows_loaded"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
