"""tessera: Spark-native annotation, labelling and evaluation operators.

Every operator takes DataFrames / Columns and returns DataFrames / Columns;
nothing is collected to the driver. See README.md for the operator map.
"""

from tessera.session import build_session, checkpoint_dir, cut_lineage, table

__all__ = ["build_session", "checkpoint_dir", "cut_lineage", "table"]
