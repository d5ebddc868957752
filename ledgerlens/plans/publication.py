"""EXT-3: write, audit, publish.

A run's tables are written but not visible. The declared rules are evaluated on exactly
what the run wrote; rows that fail a ``quarantine`` rule move to ``quar.<table>``, a failing
``block`` rule keeps its table (or the whole run) from being published, and the results are
kept in ``meta.dq_result`` either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.operators.extensions import QualityRule, evaluate_rules, split_quarantine
from ledgerlens.plans.warehouse import Warehouse
from ledgerlens.schemas import PRIMARY_KEYS

RESULT_KEY = ("run_id", "rule_id")


class Blocked(RuntimeError):
    """A ``block`` rule failed; ``tables`` names what it kept from being published."""

    def __init__(self, tables: list[str]):
        super().__init__(f"blocked by a quality rule: {', '.join(tables)}")
        self.tables = tables


def audit_run(run: Warehouse, rules: list[QualityRule], namespace: str = "canon",
              keys: dict[str, tuple[str, ...]] = PRIMARY_KEYS) -> list[str]:
    """Evaluate ``rules`` on the rows the open ``run`` has written, set quarantined rows
    apart, and record the results in the run; the tables a ``block`` rule stops."""
    spark = run.spark
    staged = {r.table for r in rules if f"{namespace}.{r.table}" in run.staged}
    rules = [r for r in rules if r.table in staged]
    if not rules:
        return []
    written = {t: run.written(f"{namespace}.{t}") for t in sorted(staged)}
    results = evaluate_rules(written, rules).collect()  # a row per rule
    failed = {(r.table_name, r.action) for r in results if r.failed_rows}
    for table in sorted(t for t, action in failed if action == "quarantine"):
        good, held = split_quarantine(written[table], [r for r in rules if r.table == table])
        run.quarantine(f"{namespace}.{table}", good, held, keys[table])
    kept = spark.createDataFrame([(run.run_id, *r) for r in results], "run_id string, rule_id string, table_name string, "
                                 "dimension string, severity string, action string, failed_rows long, total_rows long")
    run.upsert("meta.dq_result", kept, RESULT_KEY, partition_col=None)
    return sorted(f"{namespace}.{t}" for t, action in failed if action == "block")


def publish_audited(run: Warehouse, blocked: list[str], whole: bool = True) -> int:
    """Publish the run if no table is blocked. Else, with ``whole``, only the evidence is
    published (rule results and quarantined rows) and :class:`Blocked` is raised; without,
    every table but the blocked ones is published."""
    evidence = ("meta.dq_result",)
    if blocked and whole:
        run.publish(only=[t for t in run.staged if t in evidence or t.startswith("quar.")])
        raise Blocked(blocked)
    return run.publish(only=[t for t in run.staged if t not in blocked])


def published_rows(warehouse: Warehouse, tables: list[str], date_col: str = "as_of_date") -> DataFrame:
    """Per table and date: rows that readers see, and rows held in quarantine."""
    from functools import reduce

    from pyspark.sql import functions as F
    out = []
    for t in tables:
        for table, here in ((f"canon.{t}", "published_rows"), (f"quar.{t}", "quarantined_rows")):
            if warehouse.exists(table):
                rows = warehouse.read(table).groupBy(date_col).agg(F.count(F.lit(1)).alias("n"))
                out.append(rows.select(F.lit(t).alias("table_name"), date_col, *[
                    (F.col("n") if c == here else F.lit(0).cast("long")).alias(c) for c in ("published_rows", "quarantined_rows")]))
    return reduce(DataFrame.unionByName, out).groupBy("table_name", date_col).agg(
        F.sum("published_rows").alias("published_rows"), F.sum("quarantined_rows").alias("quarantined_rows"))
