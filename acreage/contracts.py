"""Column contracts checked when an operator is entered; they read schemas, never rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """An input relation does not have the columns an operator needs."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def untyped_columns(df: DataFrame) -> list[str]:
    """Columns whose type is void (an uncast NULL literal); files cannot hold them."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]


def drop_untyped(df: DataFrame) -> DataFrame:
    return df.drop(*untyped_columns(df))


def cast_untyped(df: DataFrame, types: Mapping[str, str] | None = None, default: str = "string") -> DataFrame:
    """Give void columns a type: the one in ``types``, else ``default``."""
    types = types or {}
    return df.withColumns({c: F.col(c).cast(types.get(c, default)) for c in untyped_columns(df)})


def resolve_column(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """First column equal to a candidate ignoring case, else the first that contains one."""
    columns = list(columns)
    candidates = [c.lower() for c in candidates]
    for wanted in candidates:
        for name in columns:
            if name.lower() == wanted:
                return name
    for wanted in candidates:
        for name in columns:
            if wanted in name.lower():
                return name
    return None
