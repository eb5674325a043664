"""Column expressions and projections: labels, flags, defaults, alignment to a schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.functions.predicates import as_column


def label(col: str | Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Code to label. A tuple key stands for any of its codes; other codes, and NULL, get `default`."""
    c = as_column(col)
    rules = [(c.isin(*k) if isinstance(k, tuple) else c == F.lit(k), v) for k, v in mapping.items()]
    return first_rule(rules, default)


def first_rule(rules: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first rule whose condition is true; unknown counts as false."""
    (cond, value), *rest = rules
    out = F.when(cond, value)
    for cond, value in rest:
        out = out.when(cond, value)
    return out if default is None else out.otherwise(default)


def flag(cond: Column) -> Column:
    """A boolean that is never NULL: unknown becomes false."""
    return F.coalesce(cond, F.lit(False))


def remap(col: str | Column, value: Any, replacement: Column) -> Column:
    c = as_column(col)
    return F.when(c == F.lit(value), replacement).otherwise(c)


def child_or_parent(child: str | Column, parent: str | Column) -> Column:
    return F.coalesce(as_column(child), as_column(parent))


def to_bigint(col: str | Column, strict: bool = True) -> Column:
    """Cast to BIGINT. Text that is no number fails the query, or gives NULL when not `strict`."""
    c = as_column(col)
    return c.cast("bigint") if strict else c.try_cast("bigint")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema`, in its order and types, matched by name."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def fill_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add each column of `schema` that `df` lacks, as a typed NULL."""
    present = set(df.columns)
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in present}
    )


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any], schema: T.StructType) -> DataFrame:
    """Add constant columns, typed as in `schema`."""
    return df.withColumns(
        {name: F.lit(value).cast(schema[name].dataType) for name, value in defaults.items()}
    )
