"""Naming an intermediate value so that it is computed once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` applied to `value`, which is evaluated once however often `body` uses it.

    A column expression is copied wherever it is used, also into lambdas that
    run once per array element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like withColumns, but later filters on the new columns stay above them.

    A filter pushed below the projection would copy the whole expression, and
    again each expression inside it. The one-element explode stops that.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(packed)).alias("_once")).select(*kept, "_once.*")
