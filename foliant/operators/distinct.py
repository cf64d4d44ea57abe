"""Expensive functions once per distinct value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_distinct(df: DataFrame, columns: list[str], made: dict[str, Callable[..., Column]]) -> DataFrame:
    """df with new columns computed on the distinct combinations of `columns` and joined back, nulls included.

    The optimizer doesn't move a Python function below a distinct; this does. Adaptive execution broadcasts the
    distinct side where its measured size allows it.
    """
    small = df.select(*columns).distinct()
    small = small.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    small = small.withColumns({n: f(*[F.col(f"_k{i}") for i in range(len(columns))]) for n, f in made.items()})
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(columns)]
    return df.join(small, on, "left").drop(*[f"_k{i}" for i in range(len(columns))])
