"""verbum — text mining as Spark DataFrame jobs.

A corpus is a DataFrame with one row per document.  Every operator takes
DataFrames and returns DataFrames; nothing is collected to the driver
except parameters that are bounded by construction (a class count, a
cluster count, a single convergence flag).
"""

from verbum.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
