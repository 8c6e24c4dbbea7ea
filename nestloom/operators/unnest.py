"""Deeply nested records as related flat tables.

A bottom-up tree automaton gives every node of a record a state: what kind of value it is, and
for objects the states of the parts that matter, down to whether each scalar is of its type.  The
state of an item is its variant; every variant has its own typed table, and all variants of one
list share the supertype's columns: the record, the item's place, its parent's place and its key.
A scalar of another type makes another variant, whose table has that value as JSON text instead
of a converted one.  The typed tables are written once, each in its own folder, and what all
tables share is read from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestloom.functions.ids import short_id
from nestloom.functions.lattice import ABSENT, BOOL, INT, LIST, NUMBERS, OBJECT, TEXT, kind
from nestloom.runtime import materialize, union_all


@dataclass(frozen=True)
class Child:
    """A list to be made a table: its field, the part of an item that carries its key ('' for the item itself), typed scalars (by path), nested lists."""

    name: str
    key: str
    scalars: tuple[tuple[str, str], ...] = ()
    children: tuple[Child, ...] = field(default=())


#: The column of scalars that are not of their type, in the tables of variants that have some.
MISFITS = "misfits"
_STATES = {OBJECT: "object", LIST: "list", TEXT: "text", ABSENT: "absent"}


def state(v: Column) -> Column:
    """The state of a node: absent, text, object, list or scalar."""
    names = F.create_map(*[F.lit(x) for pair in _STATES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, kind(v)), F.lit("scalar"))


def resolved(v: Column) -> Column:
    """The value itself, or what a string with JSON text holds."""
    text = F.try_variant_get(v, "$", "string")
    looks = (kind(v) == TEXT) & text.rlike(r'^\s*([\[{"]|null\s*$)')
    return F.when(looks, F.coalesce(F.try_parse_json(text), v)).otherwise(v)


def part(v: Column, name: str) -> Column:
    return v if name == "" else F.try_variant_get(v, f"$.{name}", "variant")


def items(v: Column) -> Column:
    """The items of a list; one object or one id in place of a list is a list of one; else null."""
    alone = (kind(v) == OBJECT) | ((kind(v) == TEXT) & short_id(F.try_variant_get(v, "$", "string")).isNotNull())
    return F.when(kind(v) == LIST, F.try_variant_get(v, "$", "array<variant>")).when(alone, F.array(v))


def key_of(node: Column) -> Column:
    """The short id of a node that is an object with an id or a bare id; '' if there is none."""
    text = F.when(kind(node) == TEXT, F.try_variant_get(node, "$", "string")).when(kind(node) == OBJECT, F.try_variant_get(node, "$.id", "string"))
    return F.coalesce(short_id(text), F.lit(""))


def node_of(item: Column, child: Child) -> Column:
    """The part of an item that carries its key: the item itself if it is a bare id."""
    return item if child.key == "" else F.when(kind(item) == TEXT, item).otherwise(resolved(part(item, child.key)))


def variant_of(item: Column, node: Column, child: Child) -> Column:
    """The automaton's state of an item: its kind, and for objects the states of its key and its lists, and the scalars that are not of their type."""
    states = [F.concat(F.lit(f"{child.key}="), state(node))] if child.key else []
    states += [F.concat(F.lit(f"{c.name}="), state(part(item, c.name))) for c in child.children]
    inner = F.concat(F.lit("("), F.concat_ws(",", *states), F.lit(")")) if states else F.lit("")
    off = [F.when(~fits(v, to), F.lit(f"!{name}")) for name, (v, to) in scalar_nodes(item, node, child).items()]
    return F.when(kind(item) == OBJECT, F.concat(F.lit("object"), inner, F.concat_ws("", *off))).otherwise(state(item))


_KINDS = {"string": (TEXT,), "boolean": (BOOL,), "double": NUMBERS, "int": (INT,), "bigint": (INT,)}


def fits(v: Column, to: str) -> Column:
    """Whether a scalar's node is of a type, or not there."""
    return kind(v).isin(ABSENT, *_KINDS.get(to, (LIST,)))


def scalar_nodes(item: Column, node: Column, child: Child) -> dict[str, tuple[Column, str]]:
    """name -> (node, type) of an item's scalars; paths below the key's part also reach into parts that are JSON text."""
    out = {}
    for path, to in child.scalars:
        below = child.key != "" and path.startswith(f"{child.key}.")
        found = F.try_variant_get(node, f"$.{path[len(child.key) + 1 :]}", "variant") if below else F.try_variant_get(item, f"$.{path}", "variant")
        out[path.replace(".", "_")] = (found, to)
    return out


def scalars_of(child: Child) -> dict[str, Column]:
    """The typed scalars of a row's item, null where they are of another type, and ``misfits``: these by name, as JSON text."""
    found = scalar_nodes(F.col("item"), F.col("node"), child)
    out = {name: F.when(fits(v, to), F.try_variant_get(v, "$", to)) for name, (v, to) in found.items()}
    if found:
        pairs = [F.when(~fits(v, to), F.struct(F.lit(name).alias("key"), F.to_json(v).alias("value"))) for name, (v, to) in found.items()]
        held = F.array_compact(F.array(*pairs))
        out[MISFITS] = F.when(F.size(held) > 0, F.map_from_entries(held))
    return out


def by_table(table: Column, children: list[Child], value: Callable[[Child], Column]) -> Column:
    """The value of the child whose table a row belongs to."""
    out = value(children[-1])
    for c in reversed(children[:-1]):
        out = F.when(table == c.name, value(c)).otherwise(out)
    return out


def placed(table: Column, parent_pos: Column, pos: Column, item: Column) -> Column:
    return F.struct(table.alias("child_table"), parent_pos.cast("int").alias("parent_pos"), pos.cast("int").alias("item_pos"), resolved(item).alias("item"))


def supertype(df: DataFrame, record_id: Column, record: Column, children: list[Child], typed: bool = False) -> DataFrame:
    """``record_id, child_table, parent_pos, item_pos, item_key, variant`` of all items of all children.

    ``typed`` adds a struct of scalars for each child that has any, null in rows of other children.

    ``record`` is a variant column; null records (unparsable lines) give no rows.  Nested lists
    carry the position of the item they are in, top lists -1.  Null items give no row but keep
    their place.  Every record is read once, for all tables together.
    """
    tops = df.select(record_id.alias("record_id"), record.alias("record")).where("record IS NOT NULL")
    lists = F.array(*[F.struct(F.lit(c.name).alias("child_table"), resolved(part(F.col("record"), c.name)).alias("held")) for c in children])
    held = tops.select("record_id", F.inline(lists)).where("held IS NOT NULL")
    rows = held.select("record_id", "child_table", F.posexplode(items(F.col("held"))).alias("pos", "raw"))
    rows = rows.select("record_id", placed(F.col("child_table"), F.lit(-1), F.col("pos"), F.col("raw")).alias("row"))
    everything, level = list(children), list(children)
    while nested := [(c, n) for c in level for n in c.children]:
        # each item together with the items of its own lists
        below = [
            F.when(F.col("row.child_table") == c.name, F.transform(items(resolved(part(F.col("row.item"), n.name))), _placer(n.name)))
            for c, n in nested
        ]
        none = F.array().cast("array<struct<child_table:string,parent_pos:int,item_pos:int,item:variant>>")
        rows = rows.select("record_id", F.explode(F.concat(F.array("row"), *[F.coalesce(b, none) for b in below])).alias("row"))
        level = [n for _, n in nested]
        everything += level
    flat = rows.select("record_id", "row.*").where(kind(F.col("item")) != ABSENT)
    flat = flat.withColumn("node", by_table(F.col("child_table"), everything, lambda c: node_of(F.col("item"), c)))
    variant = by_table(F.col("child_table"), everything, lambda c: variant_of(F.col("item"), F.col("node"), c))
    held = [F.when(F.col("child_table") == c.name, F.struct(*[v.alias(n) for n, v in scalars_of(c).items()])).alias(c.name) for c in everything if typed and c.scalars]
    return flat.select("record_id", "child_table", "parent_pos", "item_pos", key_of(F.col("node")).alias("item_key"), variant.alias("variant"), *held)


def _placer(name: str) -> Callable[[Column, Column], Column]:
    return lambda x, j: placed(F.lit(name), F.col("row.item_pos"), j, x)


_SHARED = ["record_id", "parent_pos", "item_pos", "item_key"]


def _nested_in(children: Iterable[Child]) -> list[Child]:
    """The children and all that is below them."""
    return [x for c in children for x in (c, *_nested_in(c.children))]


def variant_tables(df: DataFrame, record_id: Column, record: Column, *children: Child) -> dict[str, DataFrame]:
    """The typed table of each variant: the supertype's columns and the scalars of the variant.

    All tables are written in one pass, nested and bare-id ones too.  They are named by their variant
    if one child is given, and ``child/variant`` otherwise; those of nested lists always have both.
    The variants are those that occur: at most as many as the automaton has states, whatever the
    number of rows.  Tables of object variants have the child's scalars; those of variants with
    scalars of another type have these as ``misfits``; those of bare ids and other items have none.
    """
    rows = materialize(supertype(df, record_id, record, list(children), typed=True), "subtypes", "child_table", "variant")
    named = {c.name: c for c in _nested_in(children)}
    out = {}
    for child, variant in sorted(tuple(r) for r in rows.select("child_table", "variant").distinct().collect()):
        c = named[child]
        table = rows.where((F.col("child_table") == child) & (F.col("variant") == variant))
        held = [n for n in scalars_of(c) if n != MISFITS or "!" in variant] if variant.startswith("object") else []
        out[variant if len(children) == 1 and c is children[0] else f"{child}/{variant}"] = table.select(*_SHARED, *[F.col(child)[n].alias(n) for n in held])
    return out


def reunited(spark: SparkSession, tables: dict[str, DataFrame], with_scalars: bool = False) -> DataFrame:
    """All rows of typed tables named ``child/variant``: ``child_table, variant`` and the supertype's columns, and all scalars if asked.

    Scalars of one name in several children share a column; a table without one has nulls there.
    Without tables there are no rows.
    """
    if not tables:
        return spark.createDataFrame([], "child_table string, variant string, record_id string, parent_pos int, item_pos int, item_key string")
    kinds: dict[str, str] = {}
    for t in tables.values() if with_scalars else []:
        kinds |= {c: to for c, to in t.dtypes if c not in _SHARED}
    parts = []
    for name, t in tables.items():
        child, _, variant = name.partition("/")
        scalars = [F.col(c) if c in t.columns else F.lit(None).cast(to).alias(c) for c, to in kinds.items()]
        parts.append(t.select(F.lit(child).alias("child_table"), F.lit(variant).alias("variant"), *_SHARED, *scalars))
    return union_all(parts)


def from_rows(df: DataFrame, columns: list[str]) -> Column:
    """Typed columns of a table as one variant record, so that both cases go the same way."""
    return F.to_variant_object(F.struct(*columns))
