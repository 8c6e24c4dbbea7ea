"""The patterns by which fields of records become rows of tables.

Each builder takes parents, a frame with ``source_key``, the entity's id and ``value`` (the
field, as a variant or in its own type), and gives the frames of its tables.  Columns whose type
depends on the data are variants here; the canonical types are applied afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestloom.functions.lattice import TEXT, kind
from nestloom.functions.lattice import scalar_text as variant_text
from nestloom.functions.naming import target_column
from nestloom.operators.nodes import Node, at, count, entries_of, filled, flag, is_object, items_of, node, number, numeric_id, own_id, present, scalar_text, text, variant
from nestloom.plans.schema import Field

Tables = dict[str, DataFrame]
Builder = Callable[[DataFrame, Field, str], Tables]

# fixed values: the letter of a role's id
ROLE_PREFIX = {"funder": "F", "publisher": "P", "institution": "I"}


def items(parents: DataFrame, id_column: str, objects: bool = True, keep: tuple[str, ...] = ()) -> tuple[DataFrame, Node]:
    """One row an item of lists, with only those that are objects if asked, and the item as a node."""
    rows = parents.select("source_key", id_column, *keep, F.explode(items_of(node(parents, "value"))).alias("item"))
    item = node(rows, "item")
    return (rows.where(is_object(item)) if objects else rows), item


def _rows(df: DataFrame, id_column: str, **columns: Column) -> DataFrame:
    return df.select("source_key", id_column, *[c.alias(n) for n, c in columns.items()])


def _parts(item: Node, names: tuple[str, ...], renamed: dict[str, str] | None = None) -> dict[str, Column]:
    return {(renamed or {}).get(n, n): filled(at(item, n)) for n in names}


def url_list(parents: DataFrame, f: Field, id_column: str) -> Tables:
    target = f.target or target_column(f.key)
    rows, item = items(parents, id_column, False)
    return {f.table: _rows(rows, id_column, **{target: numeric_id(item)}).where(F.col(target).isNotNull())}


def id_ref(parents: DataFrame, f: Field, id_column: str) -> Tables:
    """References with the items' scalars, and for each nested list a table that repeats the parent's id."""
    target = f.target or target_column(f.key, f.id_path)
    rows, item = items(parents, id_column)
    rows = rows.withColumn("_target", own_id(at(item, f.id_path))).where("_target IS NOT NULL")
    out = {f.table: _rows(rows, id_column, **{target: F.col("_target")}, **_parts(item, f.extras, dict(f.renames)))}
    for n in f.nested:
        inner, inner_item = items(rows.select("source_key", id_column, "_target", inner_value(at(item, n.key)).alias("value")), id_column, False, ("_target",))
        child = n.target or target_column(n.key, n.id_path)
        inner = inner.withColumn("_child", numeric_id(at(inner_item, n.id_path))).where("_child IS NOT NULL")
        out[n.table] = _rows(inner, id_column, **{target: F.col("_target"), child: F.col("_child")}, **_parts(inner_item, n.extras))
    return out


def inner_value(n: Node) -> Column:
    """A list in an item, in its own type."""
    return n if isinstance(n, Column) else n.column if n.lattice is None and n.type.typeName() != "void" else variant(n)


def slug_ref(parents: DataFrame, f: Field, id_column: str) -> Tables:
    target = f.target or target_column(f.key, f.id_path)
    rows, item = items(parents, id_column)
    slug = F.substring_index(F.nullif(text(at(item, f.id_path)), F.lit("")), "/", -1)
    return {f.table: _rows(rows, id_column, **{target: slug}, **_parts(item, f.extras)).where(F.col(target).isNotNull())}


def time_series(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column)
    cells = {e: F.coalesce(number(at(item, e)), F.lit(0.0)) if e == "score" else count(at(item, e)) for e in f.extras}
    return {f.table: _rows(rows.where(present(at(item, "year"))), id_column, year=count(at(item, "year")), **cells)}


def external_ids(parents: DataFrame, f: Field, id_column: str) -> Tables:
    """One row a name in the object; falsy values, lists and objects are left out."""
    cells = parents.select("source_key", id_column, F.explode(entries_of(node(parents, "value"))).alias("source", "cell"))
    value = variant_text(F.col("cell"))
    truthy = F.when(kind(F.col("cell")) == TEXT, value != "").otherwise(~value.isin("0", "0.0", "-0.0", "False"))
    return {f.table: _rows(cells.where(truthy), id_column, source=F.col("source"), value=value)}


def string_list(parents: DataFrame, f: Field, id_column: str) -> Tables:
    target = f.target or dict(f.renames).get(f.key) or f.key.rstrip("s")
    rows, item = items(parents, id_column, False)
    return {f.table: _rows(rows, id_column, **{target: F.nullif(text(item), F.lit(""))}).where(F.col(target).isNotNull())}


def json_blob(parents: DataFrame, f: Field, id_column: str) -> Tables:
    return {f.table: _rows(parents, id_column, **{f.key: F.to_json(variant(node(parents, "value")))})}


def inverted_index(parents: DataFrame, f: Field, id_column: str) -> Tables:
    cells = parents.select("source_key", id_column, F.explode(entries_of(node(parents, "value"))).alias("word", "cell"))
    return {f.table: _rows(cells, id_column, word=F.col("word"), positions=F.try_variant_get("cell", "$", "array<bigint>"))}


def generic_list(parents: DataFrame, f: Field, id_column: str) -> Tables:
    """Flattened scalars of each item; lists of objects in an item become a table of their own."""
    rows, item = items(parents, id_column)
    out = {f.table: _rows(rows, id_column, **{c: filled(at(item, p)) for c, p, _ in f.columns})}
    for n in f.nested:
        inner, inner_item = items(rows.select("source_key", id_column, inner_value(at(item, n.key)).alias("value")), id_column)
        out[n.table] = _rows(inner, id_column, **{c: filled(at(inner_item, p)) for c, p, _ in n.columns})
    return out


def roles(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column)
    role = F.nullif(text(at(item, "role")), F.lit(""))
    prefix = F.lit("")
    for name, letter in ROLE_PREFIX.items():
        prefix = F.when(role == name, letter).otherwise(prefix)
    out = _rows(rows, id_column, role_entity_id=numeric_id(at(item, "id")), role_type=role, role_prefix=prefix)
    return {f.table: out.where("role_entity_id IS NOT NULL AND role_type IS NOT NULL")}


def topic_share(parents: DataFrame, f: Field, id_column: str) -> Tables:
    """A missing value, and a null one, is 0.0."""
    rows, item = items(parents, id_column)
    value = at(item, "value")
    out = _rows(rows, id_column, topic_id=numeric_id(at(item, "id")), value=F.when(present(value), number(value)).otherwise(F.lit(0.0)))
    return {f.table: out.where("topic_id IS NOT NULL")}


def taxonomy_parent(parents: DataFrame, f: Field, id_column: str) -> Tables:
    out = _rows(parents, id_column, **{f"{f.key}_id": numeric_id(at(node(parents, "value"), f.id_path))})
    return {f.table: out.where(F.col(f"{f.key}_id").isNotNull())}


def grants(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column)
    out = _rows(rows, id_column, funder_id=numeric_id(at(item, "funder")), **_parts(item, ("award_id",)))
    return {f.table: out.where("funder_id IS NOT NULL")}


def mesh(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column)
    names = ("descriptor_ui", "descriptor_name", "qualifier_ui", "qualifier_name")
    major = F.coalesce(flag(at(item, "is_major_topic")), F.lit(False))
    return {f.table: _rows(rows, id_column, **{n: text(at(item, n)) for n in names}, is_major_topic=major).where("descriptor_ui != ''")}


def investigators(parents: DataFrame, f: Field, id_column: str) -> Tables:
    """People with their affiliation, an object or plain text, and a table of the affiliation's ids."""
    if f.single:
        item = node(parents, "value")
        rows = parents.where(is_object(item))
    else:
        rows, item = items(parents, id_column)
    place = at(item, "affiliation")
    flags = dict(f.flags)
    names = {n: text(at(item, n)) for n in ("given_name", "family_name", "orcid")}
    person = _rows(
        rows, id_column, **names, affiliation_name=F.coalesce(text(place), text(at(place, "name"))), affiliation_country=text(at(place, "country")),
        **_parts(item, ("role_start",)), is_lead=F.lit(flags.get("is_lead", False)), is_co_lead=F.lit(flags.get("is_co_lead", False)),
    )
    out = {f.table: person}
    for n in f.nested:
        who = ("investigator_orcid", "investigator_family_name")
        named = rows.select("source_key", id_column, names["orcid"].alias(who[0]), names["family_name"].alias(who[1]), inner_value(at(item, "affiliation.ids")).alias("value"))
        named, inner = items(named, id_column, True, who)
        cells = {f"affiliation_{c}" if c != "asserted_by" else c: filled(at(inner, c)) for c in ("id", "type", "asserted_by")}
        out[n.table] = named.select("source_key", id_column, *who, *[c.alias(name) for name, c in cells.items()])
    return out


def issn(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column, False)
    return {f.table: _rows(rows, id_column, issn=F.nullif(scalar_text(item), F.lit(""))).where("issn IS NOT NULL")}


def apc_prices(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column)
    return {f.table: _rows(rows, id_column, price=number(at(item, "price")), currency=text(at(item, "currency"))).where("price IS NOT NULL")}


def societies(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column)
    return {f.table: _rows(rows, id_column, organization=text(at(item, "organization")), url=text(at(item, "url"))).where("organization != ''")}


def awards(parents: DataFrame, f: Field, id_column: str) -> Tables:
    rows, item = items(parents, id_column)
    out = _rows(
        rows, id_column, award_id=numeric_id(at(item, "id")), **_parts(item, ("display_name", "funder_award_id")),
        funder_id=numeric_id(at(item, "funder_id")), **_parts(item, ("funder_display_name",)),
    )
    return {f.table: out.where("award_id IS NOT NULL")}


def locations(parents: DataFrame, f: Field, id_column: str) -> Tables:
    """The source's id, which may be missing, and every scalar beside it."""
    rows, item = items(parents, id_column)
    return {f.table: _rows(rows, id_column, source_id=numeric_id(at(item, "source.id")), **_parts(item, f.extras))}


#: To add a pattern, add its builder here.
PATTERNS: dict[str, Builder] = {
    "url_list": url_list, "id_ref": id_ref, "nested_id_ref": id_ref, "slug_ref": slug_ref, "time_series": time_series, "external_ids": external_ids,
    "string_list": string_list, "json_blob": json_blob, "inverted_index": inverted_index, "generic_list": generic_list, "roles": roles,
    "topic_share": topic_share, "taxonomy_parent": taxonomy_parent, "grants": grants, "mesh": mesh, "investigators": investigators, "issn": issn,
    "apc_prices": apc_prices, "societies": societies, "awards": awards, "locations": locations,
}
