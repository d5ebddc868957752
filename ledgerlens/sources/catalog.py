"""SRC-3 / SRC-4: catalog scans.

The audits need "which tables exist in a layer and which columns they have,
in order". Whatever holds the tables (a metastore, a warehouse folder, or
DataFrames still in memory), the catalog is turned into one small DataFrame
``(layer, table_name, column_name, ordinal_position)`` so rules are joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()),
])


def catalog_from_schemas(spark: SparkSession,
                         layers: Mapping[str, Mapping[str, T.StructType | DataFrame]]) -> DataFrame:
    """``{layer: {table: StructType | DataFrame}}`` -> catalog DataFrame.

    Only schemas are read; no data is scanned.
    """
    rows = []
    for layer, tables in layers.items():
        for table, obj in tables.items():
            schema = obj.schema if isinstance(obj, DataFrame) else obj
            for i, f in enumerate(schema.fields, start=1):
                rows.append((layer, table, f.name, i))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def catalog_from_metastore(spark: SparkSession, databases: Mapping[str, str]) -> DataFrame:
    """``{layer: database}`` -> catalog DataFrame from the session catalog."""
    rows = []
    for layer, db in databases.items():
        for t in spark.catalog.listTables(db):
            for i, c in enumerate(spark.catalog.listColumns(t.name, db), start=1):
                rows.append((layer, t.name, c.name, i))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)
