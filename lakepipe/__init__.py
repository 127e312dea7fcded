"""lakepipe — declarative batch jobs on Spark DataFrames.

An output is declared once (``OutputSchema``: columns, types, defaults, key,
not-null and range rules) and any DataFrame is then projected, cleaned,
defaulted, validated and written by the same steps. Around that core:
native column functions, a JSON-to-rows reader, null-safe merge and unpivot,
data-quality checks, load modes, CSV exports, table mirroring, a run log with
a monitoring report, and complete jobs built on them.
"""

from .plans.job import BatchJob, Destination, RunContext
from .schema import ColumnSpec, OutputSchema
from .sinks.loaders import LoadMode

__all__ = ["BatchJob", "ColumnSpec", "Destination", "LoadMode", "OutputSchema", "RunContext"]
__version__ = "0.1.0"
