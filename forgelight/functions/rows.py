"""Columns that are computed once for a row, however often they are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """The table with further columns. Filters and columns that read them don't repeat them: each is a generated column, which the optimizer does not copy into what reads it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), where value is computed once, also where lambdas inside read it for each element."""
    return F.transform(F.array(value), of)[0]
