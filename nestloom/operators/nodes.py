"""Parts of records, read in one way whether a record is a variant or a typed column.

A node is a variant column, or a ``Typed`` one: a native column with its type, of which only the
parts that are asked for are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestloom.functions import lattice
from nestloom.functions.ids import trailing_number
from nestloom.functions.lattice import ABSENT, BOOL, FLOATS, INT, LIST, OBJECT, TEXT, kind

_COMPLEX = T.StructType | T.ArrayType | T.MapType


@dataclass(frozen=True)
class Typed:
    column: Column
    type: T.DataType

    @property
    def lattice(self) -> str | None:
        """The lattice type of a scalar; None for lists, objects and nothing."""
        if isinstance(self.type, _COMPLEX | T.NullType | T.VariantType):
            return None
        if isinstance(self.type, T.BooleanType):
            return "bool"
        return "int" if isinstance(self.type, T.IntegralType) else "float" if isinstance(self.type, T.FractionalType) else "str"

    @property
    def native(self) -> Column:
        """A scalar in the column type of its lattice type."""
        return self.column.cast(lattice.spark_type(self.lattice))


Node = Column | Typed


def nothing() -> Typed:
    return Typed(F.lit(None), T.NullType())


def node(df: DataFrame, column: str) -> Node:
    """The column of a frame as a node."""
    type_ = df.schema[column].dataType
    return F.col(column) if isinstance(type_, T.VariantType) else Typed(F.col(column), type_)


def at(n: Node, path: str) -> Node:
    """The part of a node at a dotted path; null if it is missing."""
    if isinstance(n, Typed):
        for step in path.split("."):
            if isinstance(n.type, T.StructType) and step in n.type.names:
                n = Typed(n.column[step], n.type[step].dataType)
            elif isinstance(n.type, T.MapType):
                n = Typed(F.try_element_at(n.column, F.lit(step)), n.type.valueType)
            else:
                return nothing()
        return n
    steps = "".join('["{}"]'.format(p.replace('"', "")) for p in path.split("."))
    return F.try_variant_get(n, f"${steps}", "variant")


def variant(n: Node) -> Column:
    """A node as a variant."""
    if not isinstance(n, Typed):
        return n
    return F.to_variant_object(n.column) if isinstance(n.type, _COMPLEX) else n.column.cast("variant")


def filled(n: Node) -> Column:
    """What a node holds, null if that is missing: typed scalars in their lattice type, all else as a variant."""
    if isinstance(n, Typed):
        return n.native if n.lattice else variant(n)
    return F.when(kind(n) != ABSENT, n)


def present(n: Node) -> Column:
    return n.column.isNotNull() if isinstance(n, Typed) else kind(n) != ABSENT


def is_object(n: Node) -> Column:
    if isinstance(n, Typed):
        return n.column.isNotNull() if isinstance(n.type, T.StructType | T.MapType) else F.lit(False)
    return kind(n) == OBJECT


def is_list(n: Node) -> Column:
    if isinstance(n, Typed):
        return n.column.isNotNull() if isinstance(n.type, T.ArrayType) else F.lit(False)
    return kind(n) == LIST


def items_of(n: Node) -> Column:
    """The items of a list as an array."""
    if isinstance(n, Typed):
        return n.column if isinstance(n.type, T.ArrayType) else F.lit(None).cast("array<variant>")
    return F.try_variant_get(n, "$", "array<variant>")


def entries_of(n: Node) -> Column:
    """The parts of an object as a map of variants."""
    if isinstance(n, Typed):
        if isinstance(n.type, T.StructType):
            return F.map_from_arrays(F.array(*[F.lit(f) for f in n.type.names]), F.array(*[variant(at(n, f)) for f in n.type.names]))
        if isinstance(n.type, T.MapType):
            return F.transform_values(n.column, lambda k, v: variant(Typed(v, n.type.valueType)))
        return F.lit(None).cast("map<string,variant>")
    return F.try_variant_get(n, "$", "map<string,variant>")


def text(n: Node) -> Column:
    if isinstance(n, Typed):
        return n.native if n.lattice == "str" else F.lit(None).cast("string")
    return F.when(kind(n) == TEXT, F.try_variant_get(n, "$", "string"))


def scalar_text(n: Node) -> Column:
    if isinstance(n, Typed):
        return lattice.coerce(n.native, n.lattice, "str") if n.lattice else F.lit(None).cast("string")
    return lattice.scalar_text(n)


def numeric_id(n: Node) -> Column:
    """The number that ends an id; integers are ids themselves."""
    if isinstance(n, Typed):
        return n.column.cast("bigint") if n.lattice in ("int", "bool") else trailing_number(text(n))
    return F.when(kind(n).isin(INT, BOOL), F.try_variant_get(n, "$", "bigint")).otherwise(trailing_number(text(n)))


def own_id(n: Node) -> Column:
    """The number that ends an id, as text, else what follows its last slash; null for null and empty ids."""
    given = F.nullif(text(n), F.lit(""))
    return F.coalesce(numeric_id(n).cast("string"), F.substring_index(given, "/", -1))


def number(n: Node) -> Column:
    """A number or boolean as a double, else null."""
    if isinstance(n, Typed):
        return n.native.cast("double") if n.lattice in ("int", "float", "bool") else F.lit(None).cast("double")
    return F.try_variant_get(n, "$", "double")


def count(n: Node) -> Column:
    """A count: doubles truncate, and what is missing or no number is 0."""
    if isinstance(n, Typed):
        whole = n.native.try_cast("bigint") if n.lattice in ("int", "float", "bool") else F.lit(None).cast("bigint")
    else:
        k = kind(n)
        whole = F.when(k.isin(INT, BOOL), F.try_variant_get(n, "$", "bigint")).when(k.isin(*FLOATS), F.try_variant_get(n, "$", "double").try_cast("bigint"))
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def flag(n: Node) -> Column:
    """A boolean; null for anything else."""
    if isinstance(n, Typed):
        return n.column if n.lattice == "bool" else F.lit(None).cast("boolean")
    return F.try_variant_get(n, "$", "boolean")


def in_type(n: Node, to: str) -> Column:
    """A scalar in a lattice type."""
    if isinstance(n, Typed):
        return lattice.coerce(n.native, n.lattice, to) if n.lattice else F.lit(None).cast(lattice.spark_type(to))
    return lattice.cast_cell(n, to)
