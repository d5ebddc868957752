"""SRC-1 / SRC-2: source-system CSV extracts, every column read as text.

The landing zone holds one CSV per extract with a header row. Columns are
read as strings with an explicit schema (no inference pass over the data),
doubled quotes are the escape, and an empty field becomes null. The reader
is lazy: nothing is scanned until a load needs it. What is not a record of its
extract is kept apart with its file and text, never cut or padded.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Extract names and their column order, as the source systems
# deliver them.
EXTRACT_COLUMNS: dict[str, tuple[str, ...]] = {
    "REF_party": ("src_party_id", "legal_name", "lei", "country", "sector_code",
                  "is_financial_institution", "is_group_entity"),
    "REF_party_hierarchy": ("child_src_party_id", "parent_src_party_id", "hierarchy_type",
                            "ownership_pct"),
    "REF_instrument": ("src_instrument_id", "isin", "instrument_type", "issuer_src_party_id",
                       "currency", "maturity_date"),
    "CBS_customer": ("cbs_customer_id", "customer_name", "lei", "country",
                     "src_party_id_hint"),
    "CBS_account": ("account_id", "cbs_customer_id", "product_family", "product_type",
                    "currency", "open_date", "maturity_date", "original_principal", "status"),
    "TRD_counterparty": ("trd_counterparty_id", "counterparty_name", "lei", "country"),
    "TRD_netting_agreement": ("netting_agreement_id", "trd_counterparty_id", "agreement_type",
                              "is_legally_enforceable"),
    "TRD_trade": ("trade_id", "trd_counterparty_id", "product_type", "currency", "trade_date",
                  "maturity_date", "notional", "netting_agreement_id", "src_instrument_id",
                  "status"),
    "TRD_event": ("event_id", "trade_id", "event_type", "economic_event_date",
                  "accounting_date", "notional_delta"),
    "FIN_position": ("contract_ref", "source_system", "as_of_date", "notional_outstanding",
                     "carrying_amount", "fair_value", "accrued_interest",
                     "impairment_allowance", "currency"),
    "FIN_classification": ("contract_ref", "source_system", "classification_scheme",
                           "classification_value", "as_of_date", "assessed_by_domain"),
    "COL_collateral": ("collateral_id", "collateral_type", "currency", "market_value",
                       "haircut_pct", "is_financial_collateral"),
    "COL_allocation": ("collateral_id", "contract_ref", "as_of_date", "allocated_value"),
}


def text_schema(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


#: Column that holds a line as delivered if it is not a record of its extract.
_LINE = "_line"


def _parsed(spark: SparkSession, path: str, columns: tuple[str, ...], header: bool, multiline: bool) -> DataFrame:
    schema = T.StructType([*text_schema(columns).fields, T.StructField(_LINE, T.StringType())])
    return (spark.read
            .schema(schema)
            .option("header", header)
            .option("escape", '"')
            .option("multiLine", multiline)  # a quoted line break belongs to its field
            .option("columnPruning", False)  # a pruned parser does not see surplus fields
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _LINE)
            .csv(path))


def read_extract(spark: SparkSession, path: str, columns: tuple[str, ...], header: bool = True,
                 multiline: bool = True) -> DataFrame:
    """The records of an extract. A record with more or fewer fields than the extract has is
    none; :func:`read_rejects` gives those. ``multiline=False`` lets Spark split large files
    of which it is known that no field holds a line break."""
    return _parsed(spark, path, columns, header, multiline).where(F.col(_LINE).isNull()).select(*columns)


def read_rejects(spark: SparkSession, path: str, columns: tuple[str, ...], header: bool = True,
                 multiline: bool = True) -> DataFrame:
    """``(file, line)`` of what is no record of the extract, as delivered: records and
    rejects together are all that was landed."""
    df = _parsed(spark, path, columns, header, multiline)
    # Spark parses nothing when asked for the line alone: a field goes along, as nothing
    line = F.concat_ws("", F.col(_LINE), F.substring(columns[0], 1, 0))
    return df.where(F.col(_LINE).isNotNull()).select(F.col("_metadata.file_path").alias("file"), line.alias("line"))


def landing_counts(spark: SparkSession, extracts_dir: str, names: list[str] | None = None, header: bool = True,
                   multiline: bool = True) -> DataFrame:
    """``(extract, lines, records, rejects, without_key)`` of a landing zone, one pass per
    extract; ``without_key`` are records whose first field is empty."""
    frames = []
    for name in names or list(EXTRACT_COLUMNS):
        df = _parsed(spark, os.path.join(extracts_dir, f"{name}.csv"), EXTRACT_COLUMNS[name], header, multiline)
        record = F.col(_LINE).isNull()
        frames.append(df.agg(
            F.count(F.lit(1)).alias("lines"), F.count_if(record).alias("records"), F.count_if(~record).alias("rejects"),
            F.count_if(record & F.col(EXTRACT_COLUMNS[name][0]).isNull()).alias("without_key"))
            .select(F.lit(name).alias("extract"), "*"))
    return reduce(DataFrame.unionByName, frames)


def register_extracts(spark: SparkSession, extracts_dir: str,
                      create_views: bool = True) -> dict[str, DataFrame]:
    """Read every extract found in ``extracts_dir``; keys are lower-cased names.

    A file may be ``<name>.csv`` or a directory of part files of that name.
    """
    out: dict[str, DataFrame] = {}
    for name, cols in EXTRACT_COLUMNS.items():
        path = os.path.join(extracts_dir, f"{name}.csv")
        df = read_extract(spark, path, cols)
        out[name.lower()] = df
        if create_views:
            df.createOrReplaceTempView(f"src_{name.lower()}")
    return out
