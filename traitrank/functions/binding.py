"""Sharing of intermediate values inside one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: str) -> Column:
    """The SQL lambda ``use`` applied to ``value``, which is worked out once.

    A column expression that repeats its input multiplies the generated code instead,
    beyond what the JVM compiles.
    """
    return applied(F.array(value), use)[0]


def applied(values: Column, use: str) -> Column:
    """The SQL lambda ``use`` applied to each element of an array."""
    return F.call_function("transform", values, F.expr(use))
