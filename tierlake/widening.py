"""P7/U2 with type drift: the widest type of a column over the years that have it.

Years may spell a column differently: whole numbers in one, decimals in the next, text in a
third. The order below says which type holds the values of which others; a column of two
types becomes the least type above both. Every value of the narrower type has one form in the
wider one, so nothing turns into NULL or into another value, but two numbers beyond 15 digits
may become one double. Types that no step joins (say, a structure and a number) are refused.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The steps upwards, from the narrowest; text holds all of them.
NUMBERS: tuple[DataType, ...] = (ByteType(), ShortType(), IntegerType(), LongType(), DoubleType())
_SCALARS = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType, DateType, TimestampType, TimestampNTZType)
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


def wider(a: DataType, b: DataType) -> DataType:
    """The least type that holds the values of both; raises ``TypeError`` if there is none."""
    if a == b:
        return a
    if a in NUMBERS and b in NUMBERS:
        return max(a, b, key=NUMBERS.index)
    if FloatType() in (a, b):
        other = b if a == FloatType() else a
        if other in (ByteType(), ShortType()):
            return FloatType()  # 24 bits hold their values
        if other in NUMBERS or isinstance(other, DecimalType):
            return DoubleType()
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        d, other = (a, b) if isinstance(a, DecimalType) else (b, a)
        if isinstance(other, DecimalType) or other in _DIGITS:
            scale = max(d.scale, other.scale if isinstance(other, DecimalType) else 0)
            whole = max(d.precision - d.scale, other.precision - other.scale if isinstance(other, DecimalType) else _DIGITS[other])
            return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
        if other == DoubleType():
            return DoubleType()
    dates = {DateType(), TimestampType(), TimestampNTZType()}
    if a in dates and b in dates:
        return TimestampType() if TimestampType() in (a, b) else TimestampNTZType()
    for x, y in ((a, b), (b, a)):
        if isinstance(x, StringType) and isinstance(y, (StringType, *_SCALARS)):
            return StringType()
    if isinstance(a, _SCALARS) and isinstance(b, _SCALARS):
        return StringType()
    raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def widened_schema(schemas: Iterable[StructType]) -> StructType:
    """By-name union of schemas in first-seen order, each column of its widest type."""
    types: dict[str, DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            try:
                types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
            except TypeError as e:
                raise TypeError(f"column {f.name}: {e}") from None
    return StructType([StructField(n, t, True) for n, t in types.items()])


def text_of(c: Column, of: DataType) -> Column:
    """A number, date or flag as text; whole doubles lose their \".0\", so that 5 and 5.0 are
    one text whichever year wrote them."""
    text = c.cast("string")
    if isinstance(of, (FloatType, DoubleType)):
        return F.regexp_replace(text, r"\.0$", "")
    return text


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the columns and types of a widened schema; absent columns are NULL."""
    own = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name not in own:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif own[f.name] == f.dataType:
            out.append(F.col(f"`{f.name}`"))
        elif isinstance(f.dataType, StringType):
            out.append(text_of(F.col(f"`{f.name}`"), own[f.name]).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
    return df.select(*out)


def type_report(schemas: Mapping[int, StructType]) -> list[tuple[str, int, str, str]]:
    """(column, year, its type, the widened type) where a year's type is not the widened one."""
    whole = {f.name: f.dataType for f in widened_schema(schemas[y] for y in sorted(schemas)).fields}
    rows = [(f.name, y, f.dataType, whole[f.name]) for y, s in schemas.items() for f in s.fields]
    return sorted((n, y, t.simpleString(), w.simpleString()) for n, y, t, w in rows if t != w)


__all__ = ["fitted", "type_report", "wider", "widened_schema"]
