"""ledgerlens: a banking regulatory data pipeline expressed as Spark DataFrame plans.

Source extracts are resolved to one party identity, loaded into a keyed, dated
canonical model, and read by two reporting lenses (finance and counterparty
risk) whose differences are reconciled and explained. Every mapping records
column-level lineage in the same call that builds its data.
"""

from ledgerlens.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
