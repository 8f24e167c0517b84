"""Nested document columns, stored either as JSON text or natively."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_nested(df: DataFrame, name: str, ddl: str) -> Column:
    """Typed view of a nested column. Text is parsed (bad text -> null); a native column is cast by name."""
    stored = df.schema[name].dataType
    if isinstance(stored, (T.StringType, T.NullType)):
        return F.from_json(F.col(name).cast("string"), ddl)
    wanted = T._parse_datatype_string(ddl)
    return F.col(name) if stored == wanted else _by_name(F.col(name), stored, wanted)


def _by_name(value: Column, stored: T.DataType, wanted: T.DataType) -> Column:
    """Match struct fields by name, so a native document may hold them in any order or leave some out."""
    if isinstance(wanted, T.ArrayType) and isinstance(stored, T.ArrayType):
        return F.transform(value, lambda x: _by_name(x, stored.elementType, wanted.elementType))
    if isinstance(wanted, T.StructType) and isinstance(stored, T.StructType):
        have = {f.name: f.dataType for f in stored.fields}
        fields = [
            (_by_name(value[f.name], have[f.name], f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.try_cast(wanted)


def store_as_text(df: DataFrame) -> DataFrame:
    """Landing form of a document copy: every array, struct or map column becomes one JSON string."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    return df.withColumns({name: F.to_json(F.col(name)) for name in nested}) if nested else df
