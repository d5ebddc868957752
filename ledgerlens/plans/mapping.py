"""MAP-1..4, SNK-5: mappings that build data and declare lineage in one object.

A :class:`Mapping` lists target columns, each with a Spark SQL expression over
the source relation and the source columns it reads. The same declaration
produces the DataFrame (``build``) and the lineage rows (``lineage_rows``), so
a column cannot be moved without saying where it came from.

Aggregating mappings name their grouping columns explicitly (``group_by``)
instead of hiding a ``group by`` in a ``where`` string; every other column of
such a mapping must be an aggregate expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schemas import LINEAGE_SCHEMA

# layer -> storage namespace (MAP-4)
LAYER_NAMESPACE = {"CANONICAL": "canon", "REPORTING": "rpt", "SOURCE": "src"}


def namespace_for(layer: str) -> str:
    return LAYER_NAMESPACE[layer]


@dataclass(frozen=True)
class ColumnMapping:
    """MAP-1: one target column, its expression, declared sources and description."""

    target_column: str
    expression: str
    sources: tuple[str, ...] = ()
    transformation: str = "direct copy"


def reported(target: str, *sources: str, sql: str | None = None, missing: str | None = None,
             why: str = "") -> ColumnMapping:
    """A column of a report: by default the column named by its first source, with what
    stands for a missing value; the description says so, and ``why`` adds the rule."""
    expression = sql or (sources[0].rsplit(".", 1)[-1] if sources else target)
    text = "from " + " and ".join(dict.fromkeys(s.split(".", 1)[-1] for s in sources)) if sources else "set by the run"
    if missing is not None:
        expression, text = f"coalesce({expression}, {missing})", f"{text}, {missing} where missing"
    return ColumnMapping(target, expression, sources, f"{text}; {why}" if why else text)


def run_date(as_of: str, aggregated: bool = False) -> ColumnMapping:
    """The reporting date, a parameter of the run."""
    literal = f"date '{as_of}'"
    return ColumnMapping("as_of_date", f"max({literal})" if aggregated else literal, (),
                         "reporting date of the run")


@dataclass(frozen=True)
class Mapping:
    """MAP-2: a complete source-to-target mapping."""

    rule_id: str
    target_layer: str
    target_table: str
    source_layer: str
    source_label: str            # the source table recorded for bare column names
    columns: tuple[ColumnMapping, ...]
    where: str | None = None
    group_by: tuple[str, ...] = ()
    regulatory_facing: bool = True
    population: str = ""         # the filter, where the source relation applies it

    @property
    def predicate(self) -> str:
        """Which rows reach the target, and how they are grouped."""
        rows = " and ".join(p for p in (self.where, self.population) if p) or "all rows"
        return f"{rows}; by {', '.join(self.group_by)}" if self.group_by else rows

    @property
    def target(self) -> str:
        return f"{namespace_for(self.target_layer)}.{self.target_table}"

    @property
    def target_columns(self) -> list[str]:
        return [c.target_column for c in self.columns]

    def build(self, source: DataFrame) -> DataFrame:
        """The mapping as a lazy DataFrame over ``source``."""
        df = source.where(self.where) if self.where else source
        if not self.group_by:
            return df.select(*[F.expr(c.expression).alias(c.target_column) for c in self.columns])
        keys = [F.expr(c.expression).alias(c.target_column)
                for c in self.columns if c.target_column in self.group_by]
        aggs = [F.expr(c.expression).alias(c.target_column)
                for c in self.columns if c.target_column not in self.group_by]
        return df.groupBy(*keys).agg(*aggs).select(*self.target_columns)

    def lineage_rows(self) -> list[tuple]:
        """SNK-5: one row per (target column, declared source).

        A bare source name is attributed to ``source_label``; ``table.column``
        is split on the last dot; a column with no source (a constant or a
        whole-row derivation) records the empty string. Rows with the same
        lineage key collapse to the last declaration.
        """
        rows: dict[tuple, tuple] = {}
        for col in self.columns:
            for raw in (col.sources or ("",)):
                if raw and "." in raw:
                    src_table, src_col = raw.rsplit(".", 1)
                else:
                    src_table, src_col = self.source_label, raw or ""
                key = (self.rule_id, self.target_table, col.target_column, src_table, src_col)
                rows[key] = (self.rule_id, self.target_layer, self.target_table,
                             col.target_column, self.source_layer, src_table, src_col,
                             col.transformation, self.regulatory_facing)
        return list(rows.values())


@dataclass
class MappingResult:
    """MAP-3: what applying a mapping yields: the data and its lineage."""

    mapping: Mapping
    data: DataFrame
    lineage: DataFrame


def lineage_frame(spark: SparkSession, mappings: list[Mapping]) -> DataFrame:
    """Lineage rows of many mappings as one DataFrame, unique on the lineage key."""
    rows: dict[tuple, tuple] = {}
    for m in mappings:
        for r in m.lineage_rows():
            rows[(r[0], r[2], r[3], r[5], r[6])] = r
    return spark.createDataFrame(list(rows.values()), LINEAGE_SCHEMA)


def apply_mapping(spark: SparkSession, mapping: Mapping, source: DataFrame) -> MappingResult:
    """Build the mapping's data and lineage together; there is no way to get one alone."""
    return MappingResult(mapping, mapping.build(source), lineage_frame(spark, [mapping]))


#: What a key that stands for a null begins with while rows are dealt.
PLACEHOLDER = "~"


def spread_nulls(df: DataFrame, key: str, by: str) -> DataFrame:
    """``df`` with a null ``key`` replaced by a value that no surrogate key has, different
    for each ``by``: a left join on it finds nothing for these rows either, and they are
    dealt over all tasks instead of meeting in one."""
    return df.withColumn(key, F.coalesce(F.col(key), F.concat(F.lit(PLACEHOLDER), F.col(by))))


def unspread(key: str):
    """The key as it was before :func:`spread_nulls`."""
    return F.when(~F.col(key).startswith(PLACEHOLDER), F.col(key))
