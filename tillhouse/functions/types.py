"""Type tokens: fill, cast and project a frame to a column contract in one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Local business time has no zone, so the 'date' token is a zone-less timestamp.
TOKEN_TYPES: dict[str, T.DataType] = {
    "str": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "date": T.TimestampNTZType(),
    "day": T.DateType(),
    "bool": T.BooleanType(),
    "list": T.ArrayType(T.StringType()),
    "list_from_str": T.ArrayType(T.StringType()),
}


def token_type(token: str) -> T.DataType:
    """Unknown tokens are strings."""
    return TOKEN_TYPES.get(token, T.StringType())


def missing_value(token: str) -> Column:
    target = token_type(token)
    if isinstance(target, T.ArrayType):
        return F.array().cast(target)
    return F.lit(None).cast(target)


def cast_value(value: Column, token: str) -> Column:
    """Best-effort cast: what cannot be read becomes null instead of failing the job."""
    if token == "list_from_str":
        return split_codes(value.try_cast("string"))
    return value.try_cast(token_type(token))


def split_codes(value: Column) -> Column:
    """Comma list to array; a missing list is one empty code, as the source system writes it."""
    return F.split(F.coalesce(value, F.lit("")), ",")


def add_missing(df: DataFrame, tokens: Mapping[str, str]) -> DataFrame:
    absent = {name: missing_value(token) for name, token in tokens.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def cast_known(df: DataFrame, tokens: Mapping[str, str]) -> DataFrame:
    known = {name: cast_value(F.col(name), token) for name, token in tokens.items() if name in df.columns}
    return df.withColumns(known) if known else df


def conform(df: DataFrame, tokens: Mapping[str, str]) -> DataFrame:
    """Exactly the contract's columns, in order: present ones cast, absent ones filled."""
    present = set(df.columns)
    return df.selectExpr(*[f"{_conform_sql(name, token, name in present)} as {name}" for name, token in tokens.items()])


def _conform_sql(name: str, token: str, is_present: bool) -> str:
    target = token_type(token)
    if not is_present:
        return f"cast({'array()' if isinstance(target, T.ArrayType) else 'null'} as {target.simpleString()})"
    if token == "list_from_str":
        return f"split(coalesce(try_cast({name} as string), ''), ',')"
    return f"try_cast({name} as {target.simpleString()})"


def void_to_string(df: DataFrame) -> DataFrame:
    """A column that is null in every row has no type yet; store it as string so the schema stays stable."""
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    return df.withColumns({name: F.col(name).cast("string") for name in untyped}) if untyped else df


def audit_columns(df: DataFrame, by: str = "default") -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({
        "created_at": now, "updated_at": now, "created_by": F.lit(by), "updated_by": F.lit(by),
    })
