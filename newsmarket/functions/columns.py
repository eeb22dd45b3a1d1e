"""Names of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(name: str, *tables: DataFrame) -> str:
    """The name, longer by as many underscores as it takes to be no column of the tables, whatever the case."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name
