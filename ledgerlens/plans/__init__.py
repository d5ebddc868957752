from ledgerlens.plans.mapping import ColumnMapping, Mapping, MappingResult, apply_mapping, lineage_frame
from ledgerlens.plans.warehouse import Warehouse, keyed_upsert

__all__ = ["ColumnMapping", "Mapping", "MappingResult", "apply_mapping", "lineage_frame",
           "Warehouse", "keyed_upsert"]
