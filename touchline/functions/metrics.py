"""Small metric building blocks shared by the gold operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(predicate: Column) -> Column:
    """1/0 indicator; a NULL predicate counts as 0."""
    return F.when(predicate, 1).otherwise(0)
