"""From a schema to one plan per table, with one type per column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestloom.functions.lattice import cast_cell, coerce, spark_type
from nestloom.operators.nodes import Node, Typed, at, in_type, is_list, is_object, node, nothing, own_id
from nestloom.operators.patterns import PATTERNS, inner_value
from nestloom.plans.schema import Schema
from nestloom.runtime import union_all

_NAMES = {"bigint": "int", "string": "str", "double": "float", "boolean": "bool"}


class UnexpectedColumns(ValueError):
    """Data holds columns that the canonical schema of their table doesn't have."""


class Records:
    """Records with their id, ``source_key`` and <id>, and the parts of each as nodes.

    Typed records are taken apart into their fields first, so that a plan holds, and the scan
    reads, only those fields that some table takes a part of.
    """

    def __init__(self, records: DataFrame, schema: Schema) -> None:
        kind = records.schema["record"].dataType
        self.typed = isinstance(kind, T.StructType)
        self.fields: dict[str, T.DataType] = {f.name: f.dataType for f in kind.fields} if self.typed else {}
        rows = records.where("record IS NOT NULL")
        if self.typed:
            rows = rows.select("source_key", *[F.col("record")[f].alias(f"_field_{f}") for f in self.fields])
        own = own_id(self.part(schema.id_path)).try_cast(spark_type(schema.id_type))
        self.rows = rows.withColumn("_own", own).where("_own IS NOT NULL").withColumnRenamed("_own", schema.id_column)

    def part(self, path: str) -> Node:
        """The part of a record at a dotted path."""
        if not self.typed:
            return at(F.col("record"), path)
        first, _, rest = path.partition(".")
        if first not in self.fields:
            return nothing()
        held = Typed(F.col(f"_field_{first}"), self.fields[first])
        return at(held, rest) if rest else held


def raw_tables(records: DataFrame, schema: Schema, wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The plans of the wanted tables (all by default); columns of undetermined type are variants.

    Fields of one table are united by column name.  Plans of other tables aren't built at all.
    """
    keep = set(wanted) if wanted is not None else {*schema.table_names(), schema.main}
    base = Records(records, schema)
    parts: dict[str, list[DataFrame]] = {}
    main = [c for f in schema.fields if f.pattern == "scalar" for c in f.columns]
    if main and schema.main in keep:
        cells = [in_type(base.part(path), type_).alias(column) for column, path, type_ in main]
        parts[schema.main] = [base.rows.select("source_key", schema.id_column, *cells)]
    for f in schema.fields:
        if f.pattern == "scalar" or not keep & {f.table, *(n.table for n in f.nested)}:
            continue
        parents = base.rows.select("source_key", schema.id_column, inner_value(base.part(f.key)).alias("value"))
        held = node(parents, "value")
        parents = parents.where(is_object(held) if f.single else is_list(held))
        for table, df in PATTERNS[f.pattern](parents, f, schema.id_column).items():
            if table in keep:
                parts.setdefault(table, []).append(df)
    return {table: _united(frames) for table, frames in parts.items()}


def _united(frames: list[DataFrame]) -> DataFrame:
    """Frames by name; a column that only one of them has as a variant is a variant in all."""
    if len(frames) == 1:
        return frames[0]
    loose = {c for df in frames for c, t in df.dtypes if t == "variant"}
    aligned = [df.select(*[F.col(c).cast("variant").alias(c) if c in loose else F.col(c) for c in df.columns]) for df in frames]
    out = aligned[0]
    for df in aligned[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def tables(records: DataFrame, schema: Schema, wanted: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The plans of the wanted tables with exactly the canonical columns and types, ``source_key`` last.

    A column without data is a typed null.  A table of the schema that no record feeds is there, empty.
    """
    raw = raw_tables(records, schema, wanted)
    return {name: canonical(df, schema, name) for name, df in raw.items()}


def canonical(df: DataFrame, schema: Schema, table: str) -> DataFrame:
    columns = schema.tables.get(table)
    if not columns:
        return df
    held = dict(df.dtypes)
    extra = [c for c in held if c not in dict(columns) and c != "source_key"]
    if extra:
        raise UnexpectedColumns(f"{table}: {', '.join(extra)}")
    cells = []
    for c, t in columns:
        if c not in held:
            cell = F.lit(None).cast(spark_type(t))
        elif held[c] == "variant":
            cell = cast_cell(F.col(c), t)
        elif held[c] in _NAMES and not t.startswith("list<"):
            cell = coerce(F.col(c), _NAMES[held[c]], t)
        else:
            cell = F.col(c).cast(spark_type(t))
        cells.append(cell.alias(c))
    return df.select(*cells, "source_key")


def check_columns(seen: Schema, committed: Schema) -> None:
    """Raise if data of the seen schema has tables' columns that the committed one lacks, naming them."""
    lacking = {t: [c for c, _ in cols if c not in dict(committed.tables.get(t, ()))] for t, cols in seen.tables.items()}
    named = [f"{t}.{c}" for t, cols in lacking.items() for c in cols]
    if named:
        raise UnexpectedColumns(", ".join(named))


def table_sizes(records: DataFrame, schema: Schema) -> DataFrame:
    """Rows of every table, by name: a quick view of what a schema yields."""
    names = [df.select(F.lit(name).alias("table_name")) for name, df in raw_tables(records, schema).items()]
    return union_all(names).groupBy("table_name").agg(F.count("*").alias("n_rows"))
