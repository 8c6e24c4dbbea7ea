"""The type lattice of scalar columns, and casts that follow it.

Types are str, int, float and bool, and lists of them (``list<int>``).  A column with any string
is a string; else float holds int, and int holds bool; a column without values is a string.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = {"bool": 0, "int": 1, "float": 2, "str": 3}
_SPARK: dict[str, T.DataType] = {"str": T.StringType(), "int": T.LongType(), "float": T.DoubleType(), "bool": T.BooleanType()}


def widen(types: Iterable[str]) -> str:
    return max(types, key=_RANK.__getitem__, default="str")


def type_of(value: object) -> str | None:
    """The lattice type of a parsed JSON scalar; None for null, lists and objects."""
    return {bool: "bool", int: "int", float: "float", str: "str"}.get(type(value))


def spark_type(name: str) -> T.DataType:
    return T.ArrayType(spark_type(name[5:-1])) if name.startswith("list<") else _SPARK[name]


# fixed values: the first words of schema_of_variant texts
TEXT, OBJECT, LIST, BOOL, INT, ABSENT = "STRING", "OBJECT", "ARRAY", "BOOLEAN", "BIGINT", "VOID"
FLOATS = ("DECIMAL", "DOUBLE", "FLOAT")
NUMBERS = (INT, *FLOATS)


def kind(v: Column) -> Column:
    """What a variant holds: the first word of its schema; VOID for null and missing values."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), F.lit(ABSENT))


def number_text(d: Column) -> Column:
    """A double as text: integral values end in .0, exponents from -4 to 15 are written out, others as 1e-05."""
    text = d.cast("string")
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    sign = F.when(exponent < 0, "-").otherwise("+")
    science = F.concat(mantissa, F.lit("e"), sign, F.when(F.abs(exponent) < 10, "0").otherwise(""), F.abs(exponent).cast("string"))
    special = F.when(F.isnan(d), "nan").when(d == float("inf"), "inf").when(d == float("-inf"), "-inf")
    return F.coalesce(special, F.when(exponent.isNull(), text).when((exponent >= -4) & (exponent < 16), plain).otherwise(science))


def scalar_text(v: Column) -> Column:
    """The text of a variant scalar: True and False, integers as they are, doubles by ``number_text``; null for lists and objects."""
    k = kind(v)
    return (
        F.when(k.isin(TEXT, INT), F.try_variant_get(v, "$", "string"))
        .when(k == BOOL, F.initcap(F.try_variant_get(v, "$", "string")))
        .when(k.isin(*FLOATS), number_text(F.try_variant_get(v, "$", "double")))
    )


def cast_cell(v: Column, to: str) -> Column:
    """A variant as a lattice type; doubles truncate to int, and what has no value of the type is null."""
    if to.startswith("list<"):
        return F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: cast_cell(x, to[5:-1]))
    if to == "str":
        return scalar_text(v)
    number = F.when(kind(v).isin(*NUMBERS, BOOL), F.try_variant_get(v, "$", "double"))
    if to == "int":
        return F.when(kind(v).isin(INT, BOOL), F.try_variant_get(v, "$", "bigint")).when(kind(v).isin(*FLOATS), number.try_cast("bigint"))
    if to == "float":
        return number
    return F.when(kind(v) == BOOL, F.try_variant_get(v, "$", "boolean"))


def coerce(column: Column, source: str, to: str) -> Column:
    """A typed scalar column brought to a wider lattice type."""
    if source == to:
        return column
    if to == "str":
        return {"bool": F.initcap(column.cast("string")), "int": column.cast("string"), "float": number_text(column)}[source]
    return column.cast(spark_type(to))


def name_of(schema: str) -> str | None:
    """The lattice type of a schema_of_variant text; None for null and objects."""
    if schema.startswith("ARRAY<"):
        return f"list<{name_of(schema[6:-1]) or 'str'}>"
    if schema == "STRING":
        return "str"
    if schema == "BOOLEAN":
        return "bool"
    if schema in ("BIGINT", "INT", "SMALLINT", "TINYINT"):
        return "int"
    return "float" if schema.startswith(("DECIMAL", "DOUBLE", "FLOAT")) else None


def widen_names(names: Iterable[str | None]) -> str:
    """The lattice type of a column that held values of these types; lists win over scalars."""
    known = [n for n in names if n]
    inner = [n[5:-1] for n in known if n.startswith("list<")]
    base = widen([n for n in known if not n.startswith("list<")] + inner)
    return f"list<{base}>" if inner else base
