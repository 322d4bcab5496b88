"""orderflow: order-lifecycle event analytics on Spark DataFrames."""

from .session import checkpoint_root, cut_lineage, get_spark, prepare, scratch_path

__all__ = ["get_spark", "prepare", "checkpoint_root", "scratch_path", "cut_lineage"]
__version__ = "0.1.0"
