from ledgerlens.sources.extracts import EXTRACT_COLUMNS, read_extract, register_extracts
from ledgerlens.sources.testdata import AS_OF, EXTRACT_NAMES, testdata_extracts
from ledgerlens.sources.catalog import catalog_from_schemas, catalog_from_metastore

__all__ = [
    "EXTRACT_COLUMNS", "read_extract", "register_extracts", "AS_OF", "EXTRACT_NAMES",
    "testdata_extracts", "catalog_from_schemas", "catalog_from_metastore",
]
