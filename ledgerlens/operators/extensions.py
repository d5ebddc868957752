"""EXT-*: data rules the reference specifies in prose, as DataFrame operators.

All are joins, aggregates and fixpoints over whole tables. Where a "latest"
or "best" row per key is needed, a ``max(struct(...))`` aggregate is used
instead of a window: it is deterministic (structs compare field by field)
and partially aggregated before the shuffle, so a key holding a large share
of the rows never lands in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.lineage import impacted
from ledgerlens.session import ensure_checkpoint_dir, reached, written


def _d(v: str) -> Column:
    return F.lit(v).cast("date")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# --------------------------------------------------------------------- EXT-16
def notional_as_of(trade_event: DataFrame, as_of: str,
                   date_col: str = "economic_event_date") -> DataFrame:
    """Current notional of each arrangement from its append-only events.

    Sum of ``notional_delta`` over events dated on or before ``as_of``; events
    are immutable, so a correction is just another event in the sum.
    """
    return (trade_event.where(F.col(date_col) <= _d(as_of))
            .groupBy("arrangement_key")
            .agg(F.sum("notional_delta").cast("decimal(38,2)").alias("notional_outstanding"),
                 F.count(F.lit(1)).alias("events"),
                 F.max(date_col).alias("last_event_date"))
            .withColumn("as_of_date", _d(as_of)))


# --------------------------------------------------------------------- EXT-5
def as_known_at(df: DataFrame, keys: list[str], valid_col: str, known_col: str,
                valid_at: str, known_at: str) -> DataFrame:
    """Bi-temporal read: per key, the latest version valid at ``valid_at`` as it
    was known at ``known_at``.

    Versions with valid time after ``valid_at`` or recorded after ``known_at``
    are invisible; among the rest the one with the greatest (valid, known)
    wins, chosen by an aggregate rather than a window.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.col(valid_col).alias("_v"), F.col(known_col).alias("_k"),
                          *[F.col(c) for c in others])).alias("_best")
    return (df.where((F.col(valid_col) <= _d(valid_at)) & (F.col(known_col) <= _d(known_at)))
            .groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in others]))


#: Versions of one key that are held in one row; a key with more goes by blocks of days.
FEW_VERSIONS = 64


def as_of_join(facts: DataFrame, versions: DataFrame, keys: list[str], fact_valid: str, fact_known: str,
               valid_col: str, known_col: str, values: list[str]) -> DataFrame:
    """Each row of ``facts`` with ``values`` of the version that was valid at its own
    ``fact_valid`` as it was known at its own ``fact_known``: of the versions of its keys
    with ``valid_col`` and ``known_col`` not after these the one with the greatest (valid,
    known, values); null where there is none or a key or time of the fact is null. Versions
    without a time are never seen. All rows of ``facts`` stay, with all columns.

    No pair of a fact and a version is made. The versions of a key with few of them are one
    row, which facts meet by the key alone, so that both are dealt out once. Those of a key
    with many go by :func:`_by_blocks`.
    """
    best = F.struct(F.col(valid_col).alias("valid"), F.col(known_col).alias("known"),
                    *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    seen = written(versions.where(" and ".join(f"`{c}` is not null" for c in (*keys, valid_col, known_col)))
                   .select(*keys, best.alias("version")), "versions")
    many = written(seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW_VERSIONS).select(*keys), "many")
    some_many = not many.isEmpty()
    few = seen.join(many, keys, "left_anti") if some_many else seen
    few = few.groupBy(*keys).agg(F.collect_list("version").alias("_versions"))
    met = facts.join(few, [facts[k] == few[k] for k in keys], "left").select(
        *[facts[c] for c in facts.columns], F.array_max(F.filter(few["_versions"], lambda v: (
            v["valid"] <= facts[fact_valid]) & (v["known"] <= facts[fact_known]))).alias("_version"))
    if some_many:
        points = met.select(*keys, F.col(fact_valid).alias("_valid"), F.col(fact_known).alias("_known")).where(
            " and ".join(f"`{c}` is not null" for c in (*keys, "_valid", "_known"))).join(many, keys, "left_semi").distinct()
        found = _by_blocks(points, seen.join(many, keys, "left_semi"), keys).withColumnsRenamed(
            {"_version": "_carried"} | {k: f"_key{i}" for i, k in enumerate(keys)})
        met = met.join(found, [F.col(k) == F.col(f"_key{i}") for i, k in enumerate(keys)] + [
            F.col(fact_valid) == F.col("_valid"), F.col(fact_known) == F.col("_known")], "left").withColumn(
            "_version", F.coalesce("_carried", "_version"))
    return met.select(*facts.columns, *[F.col("_version")[f"v{i}"].alias(c) for i, c in enumerate(values)])


def _by_blocks(points: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """The ``_version`` of each point ``(keys, _valid, _known)`` that has one, of ``seen``
    ``(keys, version)``.

    A version goes into the block of days of each length 1, 2, 4, ... that its known day
    lies in; the days up to a point's known day are cut into such blocks, one a length at
    most. In a block the newest version is carried forward over the valid days. What meets
    in a block is a row per pair of dates, not per fact or version, so a key with a third
    of all rows costs no more than its dates.
    """
    day = lambda c: F.unix_date(F.col(c))
    first, last = seen.agg(F.min(day("version.known")), F.max(day("version.known"))).first()
    levels = F.sequence(F.lit(0), F.lit((last - first + 1).bit_length() - 1))
    block = lambda n, level: F.struct(level.alias("level"), F.call_function("shiftright", n, level).alias("block"))

    placed = seen.select(*keys, "version", F.explode(F.transform(
        levels, lambda level: block(day("version.known") - F.lit(first), level))).alias("b"))
    placed = placed.groupBy(*keys, "b", F.col("version.valid").alias("_valid")).agg(F.max("version").alias("version"))
    # the days 0 to n - 1 are a block for each bit set in n, the one that ends where the bit does
    n = F.least(day("_known"), F.lit(last)) - F.lit(first) + F.lit(1)
    bit = lambda level: F.call_function("shiftright", n, level).bitwiseAND(F.lit(1)) == F.lit(1)
    asked = points.where(day("_known") >= F.lit(first)).select(*keys, "_valid", "_known", F.explode(F.transform(
        F.filter(levels, bit), lambda level: F.struct(
            level.alias("level"), (F.call_function("shiftright", n, level) - F.lit(1)).alias("block")))).alias("b"))
    upto = Window.partitionBy(*keys, "b").orderBy("_valid", F.col("_known").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    carried = placed.unionByName(asked, allowMissingColumns=True).withColumn("version", F.last("version", ignorenulls=True).over(upto))
    return carried.where("_known is not null and version is not null").groupBy(
        *keys, "_valid", "_known").agg(F.max("version").alias("_version"))


# --------------------------------------------------------------------- EXT-6 / EXT-10
def tolerance_reconcile(before: DataFrame, after: DataFrame, keys: list[str], value: str,
                        tolerance: str = "0.01", before_label: str = "before",
                        after_label: str = "after") -> DataFrame:
    """Full outer join of two versions of a figure, every difference classified.

    Reasons: ``MATCH`` (within tolerance), ``CHANGED``, ``ONLY_<before>``,
    ``ONLY_<after>``. The delta is ``after - before`` with a missing side as 0.
    """
    b = before.select(*keys, F.col(value).alias("_b"), F.lit(True).alias("_in_b"))
    a = after.select(*keys, F.col(value).alias("_a"), F.lit(True).alias("_in_a"))
    j = b.join(a, keys, "full_outer")
    zero = F.lit(0).cast("decimal(20,2)")
    delta = (F.coalesce(F.col("_a"), zero) - F.coalesce(F.col("_b"), zero)).cast("decimal(38,2)")
    reason = (F.when(F.col("_in_b").isNull(), F.lit(f"ONLY_{after_label.upper()}"))
               .when(F.col("_in_a").isNull(), F.lit(f"ONLY_{before_label.upper()}"))
               .when(F.abs(delta) <= F.lit(tolerance).cast("decimal(20,2)"), F.lit("MATCH"))
               .otherwise(F.lit("CHANGED")))
    return j.select(*keys, F.col("_b").alias(f"{before_label}_{value}"),
                    F.col("_a").alias(f"{after_label}_{value}"), delta.alias("delta"),
                    reason.alias("reason"))


def reconcile_summary(diff: DataFrame) -> DataFrame:
    """Counts and delta per reason: zero unexplained means every row has one."""
    return diff.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"),
                                      F.sum("delta").cast("decimal(38,2)").alias("delta"))


# --------------------------------------------------------------------- EXT-7
def run_diff(run_a: DataFrame, run_b: DataFrame) -> DataFrame:
    """Rows only in one of two runs (multiset difference both ways): one aggregate over
    both, in which a row counts +1 and -1, so each input is read and shuffled once."""
    cols = run_a.columns
    both = run_a.withColumn("_n", F.lit(1)).unionByName(run_b.select(*cols).withColumn("_n", F.lit(-1)))
    left = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, F.lit("only_a")).otherwise(F.lit("only_b"))
    return left.withColumn("_i", F.explode(F.sequence(F.lit(1), F.abs("_n")))).select(*cols, side.alias("side"))


# --------------------------------------------------------------------- EXT-17
def with_version(df: DataFrame, run_id: str, code_version: str) -> DataFrame:
    """Stamp a publication with its run and code version."""
    return df.withColumn("run_id", F.lit(run_id)).withColumn("code_version", F.lit(code_version))


def latest_version(published: DataFrame, partition_cols: list[str],
                   version_col: str = "run_id") -> DataFrame:
    """Readers' default view: the newest published run per partition.

    For publications kept side by side in one table, the newest version is found
    by an aggregate over (partition, version) and semi-joined back. Tables of a warehouse
    need no join: ``Warehouse.read(table, stamped=True)`` reads the newest folders by name.
    """
    newest = published.groupBy(*partition_cols).agg(F.max(version_col).alias(version_col))
    return published.join(newest, partition_cols + [version_col], "left_semi")


# --------------------------------------------------------------------- EXT-4
def rejects(source: DataFrame, typed: dict[str, str], rule_id: str) -> DataFrame:
    """Values present in the source text that typing turned into null.

    ``typed`` maps a source column to the Spark SQL typing expression. One
    pass over the source: each row yields its failed columns.
    """
    checks = F.array(*[
        F.when(F.trim(F.col(src)).isNotNull() & (F.trim(F.col(src)) != "") &
               F.expr(expr).isNull(),
               F.struct(F.lit(src).alias("source_column"), F.col(src).alias("raw_value")))
        for src, expr in typed.items()])
    return (source.select(F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("r"))
            .select(F.lit(rule_id).alias("rule_id"), "r.source_column", "r.raw_value"))


def reject_summary(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("rule_id", "source_column").agg(
        F.count(F.lit(1)).alias("rejected_rows"))


def load_reconciliation(loads: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Source against canonical, per load: ``(name, source, its amount, target, its amount)``
    to row counts and typed totals on both sides and their differences."""
    money = lambda c: F.coalesce(F.sum(F.expr(f"try_cast(trim({c}) as decimal(20,2))")), F.lit(0)).cast("decimal(38,2)")
    out = []
    for name, source, given, target, got in loads:
        sides = source.agg(F.count(F.lit(1)).alias("source_rows"), money(given).alias("source_amount")).withColumns(
            {"loaded_rows": F.lit(0).cast("long"), "loaded_amount": F.lit(0).cast("decimal(38,2)")}).unionByName(
            target.agg(F.count(F.lit(1)).alias("loaded_rows"), F.coalesce(F.sum(got), F.lit(0)).cast("decimal(38,2)").alias("loaded_amount")).withColumns(
                {"source_rows": F.lit(0).cast("long"), "source_amount": F.lit(0).cast("decimal(38,2)")}))
        out.append(sides.agg(*[F.sum(c).cast(t).alias(c) for c, t in (
            ("source_rows", "long"), ("loaded_rows", "long"), ("source_amount", "decimal(38,2)"), ("loaded_amount", "decimal(38,2)"))])
            .select(F.lit(name).alias("load"), "*", (F.col("loaded_rows") - F.col("source_rows")).alias("row_difference"),
                    (F.col("loaded_amount") - F.col("source_amount")).cast("decimal(38,2)").alias("amount_difference")))
    return _union(out)


# --------------------------------------------------------------------- EXT-3
@dataclass(frozen=True)
class QualityRule:
    rule_id: str
    table: str
    dimension: str          # completeness, validity, uniqueness, ...
    severity: str           # ERROR / WARN
    action: str             # block / quarantine / flag
    condition: str          # SQL predicate a good row satisfies


def evaluate_rules(tables: dict[str, DataFrame], rules: list[QualityRule]) -> DataFrame:
    """One pass per table: failing and total rows for every rule on it.

    A row fails when the predicate is false or null.
    """
    out = []
    for table in sorted({r.table for r in rules}):
        rs = [r for r in rules if r.table == table]
        agg = tables[table].agg(F.count(F.lit(1)).alias("_n"), *[
            F.count_if(~F.coalesce(F.expr(r.condition), F.lit(False))).alias(f"_f{i}")
            for i, r in enumerate(rs)])
        out.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.table).alias("table_name"),
                     F.lit(r.dimension).alias("dimension"), F.lit(r.severity).alias("severity"),
                     F.lit(r.action).alias("action"),
                     F.col(f"_f{i}").cast("long").alias("failed_rows"),
                     F.col("_n").cast("long").alias("total_rows"))
            for i, r in enumerate(rs)])).alias("x")).select("x.*"))
    return _union(out)


def split_quarantine(df: DataFrame, rules: list[QualityRule]) -> tuple[DataFrame, DataFrame]:
    """Rows passing every quarantine rule, and the rest tagged with failed rule ids."""
    qs = [r for r in rules if r.action == "quarantine"]
    failed = F.filter(F.array(*[F.when(~F.coalesce(F.expr(r.condition), F.lit(False)),
                                       F.lit(r.rule_id)) for r in qs]),
                      lambda x: x.isNotNull())
    tagged = df.withColumn("_failed", failed)
    return (tagged.where(F.size("_failed") == 0).drop("_failed"),
            tagged.where(F.size("_failed") > 0).withColumnRenamed("_failed", "failed_rules"))


def quarantine_counts(tables: dict[str, DataFrame], rules: list[QualityRule]) -> DataFrame:
    """Per table with quarantine rules: rows that pass, and rows held back by the rules
    they fail, in one pass."""
    out = []
    for table in sorted({r.table for r in rules if r.action == "quarantine"}):
        good, held = split_quarantine(tables[table], [r for r in rules if r.table == table])
        both = good.select(F.lit("").alias("failed_rules")).unionByName(
            held.select(F.array_join("failed_rules", ",").alias("failed_rules")))
        out.append(both.groupBy("failed_rules").agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(table).alias("table_name"), "failed_rules", "rows"))
    return _union(out)


def publishable(results: DataFrame) -> DataFrame:
    """From rule results: per table whether it may be published. A failing ``block`` rule
    stops its table."""
    return results.groupBy("table_name").agg(
        F.coalesce(F.max((F.col("action") == "block") & (F.col("failed_rows") > 0)), F.lit(False)).alias("blocked")) \
        .select("table_name", (~F.col("blocked")).alias("publishable"))


def require_publishable(results: DataFrame) -> None:
    """Raise if a ``block`` rule fails; for use between a load and its publication."""
    blocked = [r["table_name"] for r in publishable(results).where("not publishable").collect()]  # one row per table
    if blocked:
        raise ValueError(f"blocked by a quality rule: {', '.join(sorted(blocked))}")


# --------------------------------------------------------------------- EXT-8
_DECADES = (190, 220)  # dates before 1900 and after 2209 share the first and last


def _decade(date: Column) -> Column:
    return F.greatest(F.lit(_DECADES[0]), F.least(F.lit(_DECADES[1]), F.floor(F.year(date) / 10).cast("int")))


def interval_join(df: DataFrame, keys: dict[str, str], date_col: str, intervals: DataFrame,
                  how: str = "left") -> DataFrame:
    """Rows of ``df`` with the intervals ``[valid_from, valid_to)`` of their key that hold
    their date (``keys``: column of ``df`` -> column of ``intervals``; a null bound is open).

    An interval is laid into the decades it touches, a row falls into one, and the join is
    on key and decade: a row meets only intervals near its date, and a hot key is an
    ordinary skewed equi-join."""
    renamed = {c: f"_i_{c}" for c in intervals.columns}
    last = F.coalesce(F.date_sub("valid_to", 1), F.lit("9999-12-31").cast("date"))
    first = F.coalesce(F.col("valid_from"), F.lit("0001-01-01").cast("date"))
    laid = intervals.where(first <= last).withColumn("_decade", F.explode(F.sequence(_decade(first), _decade(last))))
    laid = laid.withColumnsRenamed(renamed)
    cond = [F.col(a) == F.col(f"_i_{b}") for a, b in keys.items()] + [
        _decade(F.col(date_col)) == F.col("_decade"),
        F.col("_i_valid_from").isNull() | (F.col(date_col) >= F.col("_i_valid_from")),
        F.col("_i_valid_to").isNull() | (F.col(date_col) < F.col("_i_valid_to"))]
    return df.join(laid, reduce(lambda a, b: a & b, cond), how).drop("_decade")


def effective_intervals(code_list: DataFrame) -> DataFrame:
    """``(code, mapped_value, valid_from, valid_to)`` without overlaps: an entry ends when
    the next one of its code begins; of entries that begin on one day the greatest value
    counts. So no date has two values, whatever the list holds."""
    one = code_list.groupBy("code", "valid_from").agg(
        F.max(F.struct("mapped_value", F.coalesce("valid_to", F.lit("9999-12-31").cast("date")).alias("valid_to"))).alias("e")).select(
        "code", "valid_from", "e.mapped_value", "e.valid_to")
    after = F.lead("valid_from").over(Window.partitionBy("code").orderBy("valid_from"))
    return one.select("code", "mapped_value", "valid_from", F.nullif(
        F.least("valid_to", F.coalesce(after, F.lit("9999-12-31").cast("date"))), F.lit("9999-12-31").cast("date")).alias("valid_to"))


def code_list_findings(code_list: DataFrame) -> DataFrame:
    """Faults of an effective-dated list: ``(code, kind, valid_from, valid_to)`` of every
    stretch in which a code has several entries (``OVERLAP``) or, between entries, none (``GAP``)."""
    far = F.lit("9999-12-31").cast("date")
    ends = code_list.withColumn("valid_to", F.coalesce("valid_to", far))
    steps = ends.select("code", F.explode(F.array(
        F.struct(F.col("valid_from").alias("at"), F.lit(1).alias("d")), F.struct(F.col("valid_to").alias("at"), F.lit(-1).alias("d")))).alias("s"))
    steps = steps.groupBy("code", F.col("s.at").alias("at")).agg(F.sum("s.d").alias("d"))
    by = Window.partitionBy("code").orderBy("at")
    open_ = steps.withColumns({"n": F.sum("d").over(by), "until": F.lead("at").over(by)}).where("until is not null")
    kind = F.when(F.col("n") > 1, F.lit("OVERLAP")).when(F.col("n") == 0, F.lit("GAP"))
    return open_.select("code", kind.alias("kind"), F.col("at").alias("valid_from"),
                        F.nullif("until", far).alias("valid_to")).where("kind is not null")


def rows_in_findings(df: DataFrame, code_col: str, date_col: str, findings: DataFrame) -> DataFrame:
    """``findings`` with the number of rows of ``df`` that each concerns."""
    hit = interval_join(df.select(code_col, date_col), {code_col: "code"}, date_col, findings, "inner")
    counts = hit.groupBy("_i_code", "_i_kind", "_i_valid_from").agg(F.count(F.lit(1)).alias("rows"))
    return findings.join(counts, (F.col("code") == F.col("_i_code")) & (F.col("kind") == F.col("_i_kind")) &
                         (F.col("valid_from") == F.col("_i_valid_from")), "left").select(
        *findings.columns, F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def map_effective_codes(df: DataFrame, code_col: str, date_col: str,
                        code_list: DataFrame) -> DataFrame:
    """Map codes through an effective-dated code list; a row stays one row.

    ``code_list``: (code, mapped_value, valid_from, valid_to) with valid_to
    exclusive and null for open-ended. Overlapping entries are resolved by
    :func:`effective_intervals` before the interval join.
    """
    got = interval_join(df, {code_col: "code"}, date_col, effective_intervals(code_list))
    return got.withColumnRenamed("_i_mapped_value", "mapped_value").drop("_i_code", "_i_valid_from", "_i_valid_to")


def unmapped_codes(df: DataFrame, code_col: str, date_col: str,
                   code_list: DataFrame) -> DataFrame:
    """Codes (with their row counts) that the list does not map on their date."""
    mapped = map_effective_codes(df.select(code_col, date_col), code_col, date_col, code_list)
    return (mapped.where(F.col("mapped_value").isNull())
            .groupBy(F.col(code_col).alias("code"))
            .agg(F.count(F.lit(1)).alias("rows")))


# --------------------------------------------------------------------- EXT-9
def golden_value(candidates: DataFrame, key: str, value: str, precedence: str) -> DataFrame:
    """First non-null value per key in precedence order (1 = most trusted).

    Never last-writer-wins: ``min(struct(precedence, value))`` over non-null
    candidates picks the most trusted source; ties within one precedence take
    the smallest value, deterministically.
    """
    best = F.min(F.struct(F.col(precedence).alias("p"), F.col(value).alias("v")))
    return (candidates.where(F.col(value).isNotNull())
            .groupBy(key).agg(best.alias("_b"))
            .select(key, F.col("_b.v").alias(value), F.col("_b.p").alias("source_precedence")))


# --------------------------------------------------------------------- EXT-11
WALK_START = "finance derivative assets"
WALK_BOTH = "measurement difference on trades in both"
WALK_RESIDUAL = "unexplained residual"
WALK_END = "risk replacement cost"


def reconciliation_walk(rec_detail: DataFrame) -> DataFrame:
    """Walk from the finance derivative-asset total to the risk replacement cost.

    Steps: 0 start at the finance assets of all reconciled trades; 1 remove
    each finance-only reason; 2 add each risk-only reason; 3 the trades in
    both contribute their risk-minus-finance difference; 4 the residual is the
    risk total minus the walked figure (zero when every difference is
    explained); 5 the risk total. The detail is aggregated once by presence
    and reason; each aggregate row emits its contribution to every step, and
    one small group-by adds them up. A zero seed row per fixed step keeps
    those steps present on empty input.
    """
    dec = "decimal(38,2)"
    fin, rsk = F.col("fin"), F.col("rsk")
    fo = F.col("in_finance_lens") & ~F.col("in_risk_lens")
    ro = ~F.col("in_finance_lens") & F.col("in_risk_lens")
    both = F.col("in_finance_lens") & F.col("in_risk_lens")
    z = F.lit(0).cast(dec)
    g = (rec_detail.groupBy("in_finance_lens", "in_risk_lens", "difference_reason")
         .agg(F.sum(F.col("finance_asset_amount").cast(dec)).alias("fin"),
              F.sum(F.col("risk_replacement_cost").cast(dec)).alias("rsk")))
    s1 = F.when(fo, -fin).otherwise(z)
    s2 = F.when(ro, rsk).otherwise(z)
    s3 = F.when(both, rsk - fin).otherwise(z)

    def step(n, item, amount):
        return F.struct(F.lit(n).alias("step"), item.alias("item"),
                        amount.cast(dec).alias("amount"))

    rows = g.select(F.explode(F.array(
        step(0, F.lit(WALK_START), fin),
        step(1, F.when(fo, F.col("difference_reason")), s1),
        step(2, F.when(ro, F.col("difference_reason")), s2),
        step(3, F.lit(WALK_BOTH), s3),
        step(4, F.lit(WALK_RESIDUAL), rsk - (fin + s1 + s2 + s3)),
        step(5, F.lit(WALK_END), rsk))).alias("r")).select("r.*")
    seed = rec_detail.sparkSession.createDataFrame(
        [(0, WALK_START), (3, WALK_BOTH), (4, WALK_RESIDUAL), (5, WALK_END)],
        "step int, item string").withColumn("amount", z)
    return (rows.where(F.col("item").isNotNull()).unionByName(seed)
            .groupBy("step", "item").agg(F.sum("amount").cast(dec).alias("amount")))


# --------------------------------------------------------------------- EXT-18
def assets_by_sector_and_currency(fin_detail: DataFrame) -> DataFrame:
    """FIN-7 with currency in the grouping, so no total mixes currencies."""
    return (fin_detail.groupBy("as_of_date", "measurement_category", "counterparty_sector",
                               "product_family", "currency")
            .agg(F.count(F.lit(1)).alias("exposure_count"),
                 F.sum("asset_carrying_amount").cast("decimal(38,2)").alias("carrying_amount"),
                 F.sum("impairment_allowance").cast("decimal(38,2)")
                  .alias("impairment_allowance")))


def risk_by_currency(trades: DataFrame, arrangement: DataFrame, as_of: str) -> DataFrame:
    """The risk view's sums with the trade's currency in the grouping."""
    own = arrangement.where(F.col("as_of_date") == _d(as_of)).select("arrangement_key", "currency")
    total = lambda c, t: F.sum(c).cast(t).alias(c)
    return trades.join(own, "arrangement_key").groupBy("as_of_date", "currency", "product_type").agg(
        F.count(F.lit(1)).alias("trade_count"), total("notional", "decimal(38,2)"),
        total("replacement_cost", "decimal(38,2)"), total("potential_future_exposure", "decimal(38,6)"))


def converted(df: DataFrame, amounts: list[str], rates: DataFrame, to: str) -> DataFrame:
    """Amounts in the currency ``to`` by the table ``rates(currency, rate)``; an amount in a
    currency without a rate is null, never passed through. Adds ``converted_to``."""
    df = df.join(rates.select("currency", F.col("rate").cast("decimal(18,6)").alias("_rate")), "currency", "left")
    return df.withColumns({c: (F.col(c) * F.col("_rate")).cast("decimal(38,2)") for c in amounts}).drop("_rate").withColumn(
        "converted_to", F.lit(to))


# --------------------------------------------------------------------- EXT-2
def null_density(df: DataFrame, group_col: str, columns: list[str],
                 threshold: float = 0.5) -> DataFrame:
    """Share of nulls per column per group in one pass, stacked to rows;
    ``over_threshold`` marks supertype columns mostly empty for a family."""
    agg = df.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(columns)])
    rows = agg.select(group_col, "_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_z{i}").alias("nulls"))
        for i, c in enumerate(columns)])).alias("x"))
    ratio = (F.col("x.nulls").cast("decimal(20,0)") / F.col("_n").cast("decimal(20,0)"))
    return rows.select(group_col, F.col("x.column_name").alias("column_name"),
                       F.col("_n").alias("rows"), F.col("x.nulls").alias("null_rows"),
                       ratio.cast("decimal(9,4)").alias("null_ratio"),
                       (ratio > F.lit(threshold)).alias("over_threshold"))


# --------------------------------------------------------------------- EXT-14
def unknown_parents(hierarchy: DataFrame, party: DataFrame) -> DataFrame:
    """Hierarchy edges whose parent is not a known party on the same date."""
    known = party.select(F.col("party_key").alias("parent_party_key"), "as_of_date")
    return hierarchy.join(known, ["parent_party_key", "as_of_date"], "left_anti")


_SCOPE = ["hierarchy_type", "as_of_date"]


#: Hanging edges are peeled off before chains are jumped over while a round takes away such
#: a share of all: the rounds stay few, and on all their edges add up to twice the first.
WORTH_A_ROUND = 0.5


def _joined(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join whose sides meet in the executors, however small one of them is: dozens of
    rounds that each send a table through the driver fill its memory."""
    return a.join(b.hint("merge"), on, how)


def _peeled(edges: DataFrame, worth: float = 0.0) -> DataFrame:
    """Edges without those that hang off: whose child is nobody's parent or whose parent
    is nobody's child, again and again while a round takes away more than ``worth`` of them."""
    now = edges.checkpoint()
    n = now.count()
    while n:
        parents = now.select(*_SCOPE, F.col("parent").alias("child")).distinct()
        children = now.select(*_SCOPE, F.col("child").alias("parent")).distinct()
        now = _joined(_joined(now, parents, _SCOPE + ["child"], "left_semi"), children, _SCOPE + ["parent"], "left_semi").checkpoint()
        was, n = n, now.count()
        if was - n <= worth * was:
            break
    return now


def _knotted(edges: DataFrame) -> DataFrame | None:
    """Edges within a strongly connected component; None where there are none.

    What hangs off is peeled away; in the core every party takes the greatest name that
    reaches it, and the parties that reach that name within its share are its component.
    They are set aside and the rest is peeled again.
    """
    core, found = _peeled(edges), []
    while not core.isEmpty():
        # the greatest name that reaches a party, child to parent
        names = core.select(*_SCOPE, F.explode(F.array("child", "parent")).alias("node")).distinct().withColumn("name", F.col("node"))
        changed = True
        while changed:
            told = _joined(core, names.withColumnRenamed("node", "child"), _SCOPE + ["child"]).select(
                *_SCOPE, F.col("parent").alias("node"), "name")
            newer = names.withColumn("own", F.lit(1)).unionByName(told.withColumn("own", F.lit(0))).groupBy(*_SCOPE, "node").agg(
                F.max("name").alias("name"), F.max(F.when(F.col("own") == 1, F.col("name"))).alias("was")).checkpoint()
            changed = not newer.where("name <> was").isEmpty()
            names = newer.drop("was")
        # within a name's share, who reaches the party of that name
        inside = _joined(_joined(core, names.select(*_SCOPE, F.col("node").alias("child"), "name"), _SCOPE + ["child"]),
                         names.select(*_SCOPE, F.col("node").alias("parent"), "name"), _SCOPE + ["parent", "name"]).checkpoint()
        key = lambda c: F.struct(*_SCOPE, "name", F.col(c).alias("node"))
        members = reached(inside.select(key("parent").alias("a"), key("child").alias("b")),
                          inside.select(key("name").alias("node")).distinct()).select(F.col("node.*"))
        on = _joined(_joined(inside, members.withColumnRenamed("node", "child"), _SCOPE + ["name", "child"], "left_semi"),
                     members.withColumnRenamed("node", "parent"), _SCOPE + ["name", "parent"], "left_semi")
        found.append(on.select(*_SCOPE, "child", "parent"))
        core = _peeled(_joined(_joined(core, members.select(*_SCOPE, F.col("node").alias("child")), _SCOPE + ["child"], "left_anti"),
                               members.select(*_SCOPE, F.col("node").alias("parent")), _SCOPE + ["parent"], "left_anti"))
    return _union(found) if found else None


def _single_steps(edges: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointer jumping over the parties with one parent: tables ``(scope, node, to, ended)``
    whose k-th row of a party leads 2^k steps up, or to the first party with no or several
    parents; and the parties among them that lie on a cycle.

    Once a round ends no further party, none of the rest leads to such an end: each leads to
    a cycle, and what as many steps as there are of them reach are the cycles' parties.
    """
    one = edges.groupBy(*_SCOPE, "child").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("to")).where("n = 1").select(
        *_SCOPE, F.col("child").alias("node"), "to")
    known = one.select(*_SCOPE, F.col("node").alias("to"), F.lit(True).alias("goes_on"))
    steps = [_joined(one, known, [*_SCOPE, "to"], "left").select(*_SCOPE, "node", "to", F.col("goes_on").isNull().alias("ended")).checkpoint()]
    open_before, still, n = -1, steps[0].where("not ended"), 1
    while (left := still.count()) and (left != open_before or n < left):
        up = steps[-1].select(*_SCOPE, F.col("node").alias("to"), F.col("to").alias("next"), F.col("ended").alias("next_ended"))
        jumped = _joined(still, up, [*_SCOPE, "to"]).select(*_SCOPE, "node", F.col("next").alias("to"), F.col("next_ended").alias("ended"))
        steps.append(steps[-1].where("ended").unionByName(jumped).checkpoint())
        open_before, still, n = left, steps[-1].where("not ended"), 2 * n
    return steps, still.select(*_SCOPE, F.col("to").alias("node")).distinct()


def hierarchy_cycles(hierarchy: DataFrame) -> DataFrame:
    """Edges on a cycle, per (hierarchy_type, as_of_date), exact for any number of parents.

    What hangs off is peeled away while that is worth a round, which leaves little of a wide
    hierarchy. Chains of parties with one parent are then jumped over by doubling steps, so that the rounds
    grow with the logarithm of the depth; cycles made of such parties alone come out there.
    What is left is a graph of the parties with several parents, an edge for each chain
    between two of them, in which :func:`_knotted` finds the cycles; a chain on one of these
    is marked by the same doubling steps. All steps are joins and aggregates over the
    edges, written to the checkpoint folder.
    """
    ensure_checkpoint_dir(hierarchy.sparkSession)
    edges = (hierarchy.select(*_SCOPE, F.col("child_party_key").alias("child"), F.col("parent_party_key").alias("parent"))
             .where("child is not null and parent is not null").distinct())
    edges = _peeled(edges, WORTH_A_ROUND)
    steps, marked = _single_steps(edges)
    single = steps[0].select(*_SCOPE, F.col("node").alias("child"))
    several = _joined(edges, single, [*_SCOPE, "child"], "left_anti")
    ends = steps[-1].where("ended").select(*_SCOPE, F.col("node").alias("parent"), F.col("to").alias("end"))
    hops = _joined(several, ends, [*_SCOPE, "parent"], "left").select(
        *_SCOPE, "child", F.coalesce("end", "parent").alias("parent"), F.col("parent").alias("by")).checkpoint()
    knots = _knotted(hops.select(*_SCOPE, "child", "parent").distinct())
    if knots is not None:
        on = _joined(hops, knots, [*_SCOPE, "child", "parent"], "left_semi").select(*_SCOPE, "child", F.col("by").alias("parent"))
        chain = on.select(*_SCOPE, F.col("parent").alias("node")).distinct().checkpoint()
        length = chain.count()
        for step in steps:  # the first parties of chains, then twice as far each round
            chain = chain.unionByName(_joined(step.where("not ended"), chain, [*_SCOPE, "node"], "left_semi").select(
                *_SCOPE, F.col("to").alias("node"))).distinct().checkpoint()
            was, length = length, chain.count()
            if length == was:  # no chain goes on so far up
                break
        marked = marked.unionByName(chain).distinct()
    cyclic = _joined(steps[0], marked, [*_SCOPE, "node"], "left_semi").select(*_SCOPE, F.col("node").alias("child"), F.col("to").alias("parent"))
    if knots is not None:
        cyclic = cyclic.unionByName(on)
    return cyclic.select(*_SCOPE, F.col("child").alias("child_party_key"), F.col("parent").alias("parent_party_key"))


# --------------------------------------------------------------------- EXT-12
def classify_schema_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """Diff two column catalogs ``(table_name, column_name, data_type)``.

    ADDED is additive, a widened decimal or int->long is compatible, and
    REMOVED or any other type change is breaking.
    """
    o = old.select("table_name", "column_name", F.col("data_type").alias("old_type"))
    n = new.select("table_name", "column_name", F.col("data_type").alias("new_type"))
    j = o.join(n, ["table_name", "column_name"], "full_outer")
    widen = ((F.col("old_type") == "int") & (F.col("new_type") == "bigint")) | (
        F.col("old_type").startswith("decimal") & F.col("new_type").startswith("decimal") &
        (F.regexp_extract("new_type", r"decimal\((\d+),(\d+)\)", 1).cast("int") >=
         F.regexp_extract("old_type", r"decimal\((\d+),(\d+)\)", 1).cast("int")) &
        (F.regexp_extract("new_type", r"decimal\((\d+),(\d+)\)", 2) ==
         F.regexp_extract("old_type", r"decimal\((\d+),(\d+)\)", 2)))
    change = (F.when(F.col("old_type").isNull(), F.lit("ADDED"))
               .when(F.col("new_type").isNull(), F.lit("REMOVED"))
               .when(F.col("old_type") == F.col("new_type"), F.lit("UNCHANGED"))
               .otherwise(F.lit("TYPE_CHANGED")))
    klass = (F.when(change == "ADDED", F.lit("additive"))
              .when(change == "UNCHANGED", F.lit("none"))
              .when((change == "TYPE_CHANGED") & widen, F.lit("compatible"))
              .otherwise(F.lit("breaking")))
    return j.select("table_name", "column_name", "old_type", "new_type",
                    change.alias("change"), klass.alias("classification"))


def catalog_with_types(spark: SparkSession, tables: dict[str, DataFrame | T.StructType]) -> DataFrame:
    rows = []
    for t, obj in tables.items():
        schema = obj.schema if isinstance(obj, DataFrame) else obj
        rows += [(t, f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


# --------------------------------------------------------------------- EXT-13
def impact(spark: SparkSession, lineage: DataFrame, source_table: str,
           source_column: str | None = None) -> DataFrame:
    """Forward lineage: every target a source column (or table) flows into."""
    return impacted(lineage, source_table, source_column)


def lineage_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Lineage rows added or removed between two runs."""
    return run_diff(previous, current).withColumn(
        "side", F.when(F.col("side") == "only_a", F.lit("removed")).otherwise(F.lit("added")))


# --------------------------------------------------------------------- EXT-1
LEI_PATTERN = r"^[0-9A-Z]{18}[0-9]{2}$"
ISIN_PATTERN = r"^[A-Z]{2}[0-9A-Z]{9}[0-9]$"


def _chars(code: Column) -> Column:
    return F.filter(F.split(code, ""), lambda ch: ch != "")


def _mod97(code: Column) -> Column:
    """ISO 7064 MOD 97-10 remainder of an alphanumeric code (A=10 .. Z=35),
    folded character by character so no big integer is ever formed."""
    return F.aggregate(
        _chars(code), F.lit(0).cast("long"),
        lambda acc, ch: F.when(ch.rlike("^[0-9]$"), (acc * 10 + ch.cast("long")) % 97)
                         .otherwise((acc * 100 + (F.ascii(ch) - 55).cast("long")) % 97))


def validate_lei(df: DataFrame, col: str = "lei") -> DataFrame:
    """Adds ``lei_format_ok`` and ``lei_checksum_ok`` (mod 97 of the code is 1)."""
    c = F.upper(F.trim(F.col(col)))
    fmt = c.rlike(LEI_PATTERN)
    return (df.withColumn("lei_format_ok", fmt)
              .withColumn("lei_checksum_ok", fmt & (_mod97(c) == 1)))


def validate_isin(df: DataFrame, col: str = "isin") -> DataFrame:
    """Adds ``isin_format_ok`` and ``isin_checksum_ok`` (Luhn over the code with
    letters expanded to two digits, A=10 .. Z=35)."""
    c = F.upper(F.trim(F.col(col)))
    fmt = c.rlike(ISIN_PATTERN)
    digits = F.array_join(F.transform(
        _chars(c), lambda ch: F.when(ch.rlike("^[0-9]$"), ch)
                               .otherwise((F.ascii(ch) - 55).cast("string"))), "")
    rev = F.transform(_chars(F.reverse(digits)), lambda ch: ch.cast("int"))
    weighted = F.transform(rev, lambda v, i: F.when(i % 2 == 1, F.when(v * 2 > 9, v * 2 - 9)
                                                                 .otherwise(v * 2))
                                                .otherwise(v))
    total = F.aggregate(weighted, F.lit(0), lambda acc, v: acc + v)
    return (df.withColumn("isin_format_ok", fmt)
              .withColumn("isin_checksum_ok", fmt & (total % 10 == 0)))


# --------------------------------------------------------------------- EXT-15
LINEAGE_COMPLETENESS_FIELDS = ("rule_id", "source_table", "target_column", "transformation",
                               "predicate", "run_id", "code_version")


def stamp_lineage(lineage: DataFrame, run_id: str, code_version: str, as_of_date: str,
                  mappings: list | None = None) -> DataFrame:
    """Lineage rows carrying run, code version and date, so a record names which run of
    which code produced it, and the population of its mapping (filter and grouping)."""
    spark = lineage.sparkSession
    known = spark.createDataFrame([(m.rule_id, m.predicate) for m in mappings or []], "rule_id string, predicate string")
    return (lineage.join(known.distinct(), "rule_id", "left")
            .withColumn("run_id", F.lit(run_id))
            .withColumn("code_version", F.lit(code_version))
            .withColumn("as_of_date", _d(as_of_date)))


def incomplete_lineage(stamped: DataFrame) -> DataFrame:
    """Lineage rows missing one of the required components."""
    missing = F.filter(F.array(*[
        F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.lit(c))
        for c in LINEAGE_COMPLETENESS_FIELDS]),
        lambda x: x.isNotNull())
    return stamped.withColumn("missing", missing).where(F.size("missing") > 0)
