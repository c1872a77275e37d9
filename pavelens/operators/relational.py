"""Joins and unions with the missing-value rules of survey tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all shared columns; null equals null and NaN equals NaN. Shared columns appear once."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns")
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in shared})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in shared])
    return left.join(r, same).drop(*[f"_r_{c}" for c in shared])


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def update(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """table with the non-null values of changes at equal keys; keys only in changes are ignored. Keys are unique in changes."""
    new = [c for c in changes.columns if c not in keys and c in table.columns]
    c = changes.select(*keys, *[F.col(x).alias(f"_n_{x}") for x in new])
    out = table.join(c, keys, "left")
    return out.select(*[F.coalesce(F.col(f"_n_{x}"), F.col(x)).alias(x) if x in new else F.col(x) for x in table.columns])


def first_known(*cs: Column) -> Column:
    """The first value that isn't missing, NaN counting as missing."""
    return F.coalesce(*[F.when(~F.isnan(c), c) for c in cs])


def skip_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done.select(key).distinct(), key, "left_anti")


def every_nth(df: DataFrame, position: str, n: int) -> DataFrame:
    return df.filter(F.pmod(F.col(position), F.lit(n)) == 0)


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without some columns; names that it lacks are ignored."""
    return df.drop(*names)


def geometry_first(df: DataFrame, *then: str) -> DataFrame:
    """Columns in the order that layers are written in: geometry, `then`, the others as they come."""
    head = [c for c in ("geometry", *then) if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in [*head, *(c for c in df.columns if c not in head)]])


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows sorted for a sink that keeps their order; nulls first."""
    return df.orderBy(*keys)
