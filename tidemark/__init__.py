"""tidemark: incremental table synchronisation on Spark DataFrames."""

from tidemark.specs import SPECS, Field, TableSpec

__all__ = ["SPECS", "Field", "TableSpec"]
