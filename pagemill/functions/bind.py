"""A value that an expression uses more than once, computed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value.  The value is the variable of a lambda, so it stands in the plan once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
