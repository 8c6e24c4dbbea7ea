"""Schema inference: the shapes of all records, and the rules that turn shapes into patterns.

Every task merges the shapes it sees, and the merged shapes of a field meet in one row; only one
shape a field comes to the driver, whatever the number of records.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterable, Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestloom.functions.lattice import type_of, widen, widen_names
from nestloom.functions.naming import singular, target_column
from nestloom.plans.schema import Field, Schema, load, merge, store
from nestloom.sources import jsonl

# fixed values: fields that repeat others, parts of list items that are not carried, names of plain text lists
SKIPPED = frozenset({"primary_location", "best_oa_location", "primary_topic"})
SKIPPED_PARTS = frozenset({"raw_affiliation_strings", "raw_author_name", "countries", "landing_page_url", "provenance"})
TEXT_LISTS = ("alternatives", "alternate_titles", "acronyms", "codes")
#: Strings of a list that are looked at for being URLs.
URL_LOOK = 5
#: Marks of a URL; the hosts of ids can be added.
URL_MARKS = ("https://", "http://")


# ---- shapes -----------------------------------------------------------------------------------
# A shape is {"t": [scalar types], "o": {part: shape} or None, "l": item shape or None, "u": a URL
# was among the first strings of a list, "k": an id names a keyword, "s": a string that doesn't
# end in a number}.


def blank() -> dict:
    return {"t": [], "o": None, "l": None, "u": False, "k": False, "s": False}


def shape_of(value: object) -> dict:
    out = blank()
    if isinstance(value, dict):
        out["o"] = {k: shape_of(v) for k, v in value.items()}
        out["k"] = isinstance(value.get("id"), str) and "/keywords/" in value["id"]
    elif isinstance(value, list):
        merged = None
        for item in value:
            if item is not None:
                merged = united(merged, shape_of(item))
        out["l"] = merged or {}
        texts = [x for x in value if isinstance(x, str)][:URL_LOOK]
        out["u"] = any(x.startswith(URL_MARKS) for x in texts)
    elif value is not None:
        out["t"] = [type_of(value)]
        out["s"] = isinstance(value, str) and value != "" and not value[-1].isdigit()
    return out


def united(a: dict | None, b: dict | None) -> dict:
    """The shape of values of either shape."""
    if not a or not b:
        return a or b or {}
    objects = [s["o"] for s in (a, b) if s["o"] is not None]
    lists = [s["l"] for s in (a, b) if s["l"] is not None]
    parts: dict | None = None
    for o in objects:
        parts = o if parts is None else {k: united(parts.get(k), o.get(k)) for k in [*parts, *(x for x in o if x not in parts)]}
    inner = None if not lists else lists[0] if len(lists) == 1 else united(lists[0], lists[1])
    return {"t": sorted({*a["t"], *b["t"]}), "o": parts, "l": inner, "u": a["u"] or b["u"], "k": a["k"] or b["k"], "s": a["s"] or b["s"]}


def observe(records: DataFrame) -> dict[str, dict]:
    """The shape of every top-level field of records (line)."""

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, dict] = {}
        for batch in batches:
            for line in batch["line"]:
                try:
                    record = json.loads(line) if line and line.strip() else None
                except (ValueError, RecursionError):
                    continue
                if isinstance(record, dict):
                    for k, v in record.items():
                        seen[k] = united(seen.get(k), shape_of(v))
        yield pd.DataFrame([(k, json.dumps(s)) for k, s in seen.items()], columns=["field", "shape"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        merged: dict = {}
        for text in pdf["shape"]:
            merged = united(merged, json.loads(text))
        return pd.DataFrame([(pdf["field"].iloc[0], json.dumps(merged))], columns=["field", "shape"])

    parts = records.select("line").mapInPandas(scan, "field string, shape string")
    rows = parts.groupBy("field").applyInPandas(join, "field string, shape string").collect()
    return {r["field"]: json.loads(r["shape"]) for r in sorted(rows, key=lambda r: r["field"])}


def typed_shape(kind: T.DataType) -> dict:
    """The shape that a column's type tells, without looking at data."""
    out = blank()
    if isinstance(kind, T.StructType):
        out["o"] = {f.name: typed_shape(f.dataType) for f in kind.fields}
    elif isinstance(kind, T.ArrayType):
        out["l"] = typed_shape(kind.elementType)
    elif isinstance(kind, T.MapType):
        out["o"] = {"": typed_shape(kind.valueType)}
    else:
        integral = isinstance(kind, T.IntegralType)
        out["t"] = ["bool" if isinstance(kind, T.BooleanType) else "int" if integral else "float" if isinstance(kind, T.FractionalType) else "str"]
    return out


def _texts(shape: dict, column: Column) -> Iterator[tuple[dict, Callable[[Callable[[Column], Column]], Column]]]:
    """Every string in a typed column, as its shape and a function that tells whether any of its values passes a test."""
    if shape["o"] is not None:
        for name, part in shape["o"].items():
            if name:
                yield from _texts(part, column[name])
    elif shape["l"] is not None:
        inner = shape["l"]
        if inner["o"] is None and inner["l"] is None:
            if inner["t"] == ["str"]:
                yield inner, lambda test: F.exists(column, test)
            return
        for path, part in _paths(inner):
            yield part, _any_item(column, path)
    elif shape["t"] == ["str"]:
        yield shape, lambda test: test(column)


def _paths(shape: dict, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], dict]]:
    """(path, shape) of the strings in a list's items; "[]" stands for the items of an inner list."""
    if shape["o"] is not None:
        for name, part in shape["o"].items():
            yield from _paths(part, (*path, name))
    elif shape["l"] is not None:
        yield from _paths(shape["l"], (*path, "[]"))
    elif shape["t"] == ["str"]:
        yield path, shape


def _any_item(column: Column, path: tuple[str, ...]) -> Callable[[Callable[[Column], Column]], Column]:
    def passes(test: Callable[[Column], Column]) -> Column:
        return F.exists(column, lambda x: _passes(x, path, test))

    return passes


def _passes(x: Column, path: tuple[str, ...], test: Callable[[Column], Column]) -> Column:
    for n, step in enumerate(path):
        if step == "[]":
            return F.exists(x, _inner(path[n + 1 :], test))
        x = x[step]
    return test(x)


def _inner(rest: tuple[str, ...], test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda y: _passes(y, rest, test)


def feeding(entity: str, shapes: dict[str, dict], wanted: Iterable[str]) -> set[str]:
    """The fields of typed records that may feed the wanted tables, whatever their data tell, and the id."""
    keep, out = set(wanted), {"id"}
    for name, shape in shapes.items():
        cases = [blank(), shape]
        if shape["l"] is not None:
            cases += [{**shape, "u": u, "l": {**shape["l"], "k": k}} for u in (False, True) for k in (False, True)]
        for own_id in (True, False):
            for case in cases:
                schema = classify(entity, {name: case}, own_id)
                if keep & {*schema.table_names(), *(schema.main for f in schema.fields if f.pattern == "scalar")}:
                    out.add(name)
    return out


def observe_table(df: DataFrame, column: str = "record", only: Callable[[dict[str, dict]], set[str]] | None = None) -> dict[str, dict]:
    """The shapes of a typed table's columns: from their types, and one aggregate that tells which are
    empty, hold URLs, name keywords or have ids without numbers.

    ``only`` names the columns of which data are read; of all others the types are all that is known.
    """
    shapes = {f.name: typed_shape(f.dataType) for f in df.schema[column].dataType.fields}
    read = only(shapes) if only else shapes.keys()
    tests: dict[str, tuple[dict, str, Column]] = {}
    for name, shape in shapes.items():
        if name not in read:
            continue
        whole = F.col(column)[name]
        held = F.size(whole) > 0 if shape["l"] is not None else whole.isNotNull()
        tests[f"c{len(tests)}"] = (shape, "held", held)
        if shape["l"] is not None and shape["l"]["t"] == ["str"]:
            tests[f"c{len(tests)}"] = (shape, "u", F.exists(F.slice(whole, 1, URL_LOOK), lambda x: F.rlike(x, F.lit("^https?://"))))
        if shape["l"] is not None and shape["l"]["o"] and "id" in shape["l"]["o"]:
            tests[f"c{len(tests)}"] = (shape["l"], "k", F.exists(whole, lambda x: x["id"].contains("/keywords/")))
        for part, any_of in _texts(shape, whole):
            tests[f"c{len(tests)}"] = (part, "s", any_of(lambda x: (x != "") & ~x.rlike("[0-9]$")))
    if not tests:
        return shapes
    row = df.agg(*[F.max(F.coalesce(c, F.lit(False))).alias(k) for k, (_, _, c) in tests.items()]).first()
    empty = []
    for k, (shape, flag, _) in tests.items():
        if flag == "held":
            if not row[k]:
                empty.append(id(shape))
        else:
            shape[flag] = bool(row[k])
    return {n: (blank() if id(x) in empty else x) for n, x in shapes.items()}


# ---- rules ------------------------------------------------------------------------------------


def scalar(s: dict | None) -> bool:
    return bool(s and s["t"])


def items_of(s: dict | None) -> dict:
    """The parts of a list's objects; empty if it holds none."""
    return (s and s["l"] and s["l"]["o"]) or {}


def leaves(parts: dict, column: str = "", path: str = "") -> list[tuple[str, str, str]]:
    """(column, path, type) of the scalars in nested objects."""
    out = []
    for k, s in parts.items():
        c, p = (f"{column}_{k}" if column else k), (f"{path}.{k}" if path else k)
        if s and s["o"] is not None:
            out += leaves(s["o"], c, p)
        elif s and (s["t"] or not s["l"] and s["l"] is None):
            out.append((c, p, widen(s["t"])))
    return out


def by_name(key: str, prefix: str) -> list[Field]:
    """The field of a value that is null or empty everywhere, as far as its name tells.

    Its table has the name it would have with data in it.
    """
    single = {"ids": ("external_ids", "external_ids"), "abstract_inverted_index": ("inverted_index", "abstracts")}
    lists = {
        "issn": ("issn", "issns"), "counts_by_year": ("time_series", key), "funded_outputs": ("url_list", key), "grants": ("grants", "funders"),
        "awards": ("awards", key), "societies": ("societies", key), "apc_prices": ("apc_prices", key), "affiliations": ("nested_id_ref", key),
    }
    if key in single:
        pattern, table = single[key]
        return [Field(key, pattern, prefix + table, single=True)]
    if key in lists:
        pattern, table = lists[key]
        extras = ("works_count", "cited_by_count", "oa_works_count") if pattern == "time_series" else ()
        return [Field(key, pattern, prefix + table, id_path="institution.id" if key == "affiliations" else "id", extras=extras)]
    return [Field(key, "string_list", prefix + key)] if key.endswith(TEXT_LISTS) else []


def object_rule(key: str, s: dict, prefix: str, main: str) -> list[Field]:
    parts = s["o"]
    if key == "ids":
        extra = [Field("ids.issn", "issn", f"{prefix}issns")] if parts.get("issn") and parts["issn"]["l"] is not None else []
        return [Field(key, "external_ids", f"{prefix}external_ids", single=True), *extra]
    if key == "abstract_inverted_index":
        return [Field(key, "inverted_index", f"{prefix}abstracts", single=True)]
    if {"id", "display_name"} <= parts.keys():
        return [Field(key, "taxonomy_parent", f"{prefix}{key}s", single=True)]
    if {"given_name", "family_name"} <= parts.keys():
        flags = (("is_lead", key == "lead_investigator"), ("is_co_lead", key == "co_lead_investigator"))
        return [Field(key, "investigators", f"{prefix}investigators", single=True, flags=flags, nested=(Field("affiliation", "investigators", f"{prefix}investigator_affiliations"),))]
    found = [c for c in leaves(parts, key, key) if scalar(_at(parts, c[1].split(".")[1:]))]
    out = [Field(key, "scalar", main, columns=tuple(found))] if found else []
    return out + [_generic(f"{key}.{k}", f"{prefix}{key}_{k}", x) for k, x in parts.items() if items_of(x)]


def _at(parts: dict, path: list[str]) -> dict | None:
    for p in path[:-1]:
        parts = (parts.get(p) or {}).get("o") or {}
    return parts.get(path[-1])


def text_rule(key: str, s: dict, prefix: str) -> list[Field]:
    if key == "issn":
        return [Field(key, "issn", f"{prefix}issns")]
    if s["u"]:
        return [Field(key, "url_list", f"{prefix}{key}")]
    return [Field(key, "string_list", f"{prefix}{key}")] if key.endswith(TEXT_LISTS) or key in ("indexed_in", "keywords") else []


def _generic(key: str, table: str, s: dict) -> Field:
    parts = items_of(s)
    nested = tuple(Field(k, "generic_list", f"{table}_{k}", columns=tuple(leaves(items_of(x)))) for k, x in parts.items() if items_of(x))
    return Field(key, "generic_list", table, columns=tuple(leaves(parts)), nested=nested)


def _reference(key: str, parts: dict, prefix: str, own_id: bool) -> Field:
    """A list of references: by the item's own id, or by the first object in it that has one."""
    holders = [k for k, x in parts.items() if x and x["o"] and "id" in x["o"]]
    holder = None if own_id and "id" in parts else next(iter(holders), None)
    carried = [
        k for k, x in parts.items()
        if k not in {"id", "display_name", "wikidata"} and not k.startswith("raw_") and k not in SKIPPED_PARTS and x and (x["t"] or x["l"] and x["l"]["t"] and not x["l"]["o"])
    ]
    inner = tuple(Field(k, "id_ref", f"{prefix}{key}_{k}") for k, x in parts.items() if k not in SKIPPED_PARTS and "id" in items_of(x))
    pattern = "nested_id_ref" if inner or holder else "id_ref"
    return Field(key, pattern, f"{prefix}{key}", id_path=f"{holder}.id" if holder else "id", extras=tuple(k for k in carried if k not in {f.key for f in inner}), nested=inner)


def list_rules(own_id: bool) -> list[tuple[Callable[[dict, dict], bool], Callable[[str, dict, str], Field]]]:
    """(test of the items' parts, the field), in the order in which the first match wins."""
    has = lambda *names: lambda parts, s: set(names) <= parts.keys()
    plain = lambda pattern, table=None: lambda key, parts, prefix: Field(key, pattern, prefix + (table or key))
    number = lambda x: bool(x and {"int", "float", "bool"} & {*x["t"]})
    names = Field("affiliation", "investigators", "")
    return [
        (has("year"), lambda key, parts, prefix: Field(key, "time_series", f"{prefix}counts_by_year", extras=tuple(k for k, x in parts.items() if k != "year" and number(x)))),
        (lambda parts, s: s["l"]["k"], lambda key, parts, prefix: Field(key, "slug_ref", prefix + key, target=f"{key.rstrip('s')}_id", extras=("score",))),
        (has("id", "role"), plain("roles", "roles")),
        (has("id", "value", "domain"), plain("topic_share", "topic_share")),
        (has("descriptor_ui"), plain("mesh", "mesh")),
        (has("price", "currency"), plain("apc_prices", "apc_prices")),
        (has("organization", "url"), plain("societies", "societies")),
        (lambda parts, s: "funder" in parts and "str" in parts["funder"].get("t", ()), plain("grants", "funders")),
        (has("id", "funder_id"), plain("awards", "awards")),
        (lambda parts, s: bool(parts.get("source") and parts["source"]["o"] is not None), lambda key, parts, prefix: Field(key, "locations", f"{prefix}locations", extras=tuple(k for k, x in parts.items() if k not in ("source", "id") and k not in SKIPPED_PARTS and not k.startswith("raw_") and scalar(x)))),
        (has("given_name", "family_name"), lambda key, parts, prefix: Field(key, "investigators", f"{prefix}investigators", nested=(replace(names, table=f"{prefix}investigator_affiliations"),))),
        (lambda parts, s: "id" in parts or any(x and x["o"] and "id" in x["o"] for x in parts.values()), lambda key, parts, prefix: _reference(key, parts, prefix, own_id)),
    ]


def classify(entity: str, shapes: dict[str, dict], prefer_own_id: bool = True) -> Schema:
    """The schema that follows from the shapes of an entity's fields.

    ``prefer_own_id``: an item with an id of its own and an object with another is a reference by
    its own; otherwise by the object's.
    """
    prefix, main = f"{singular(entity)}_", f"{singular(entity)}_main"
    fields: list[Field] = []
    for key, s in sorted(shapes.items()):
        bare = key.removeprefix("primary_").removeprefix("best_")
        if key in SKIPPED or key == "id" or bare != key and bare in shapes:
            continue
        if s and s["l"] is not None and s["l"]:
            parts = items_of(s)
            if parts:
                rule = next((make for test, make in list_rules(prefer_own_id) if test(parts, s)), None)
                fields.append(rule(key, parts, prefix) if rule else _generic(key, prefix + key, s))
            elif "str" in s["l"]["t"]:
                fields += text_rule(key, s, prefix)
        elif s and s["o"]:
            fields += object_rule(key, s, prefix, main)
        elif scalar(s):
            fields.append(Field(key, "scalar", main, columns=((key, key, widen(s["t"])),)))
        else:
            fields += by_name(key, prefix)
    return Schema(entity, tuple(fields))


def _kind(s: dict | None) -> str:
    """The column type of values of a shape."""
    if not s:
        return "str"
    if s["l"] is not None:
        return f"list<{widen((s['l'] or blank())['t'])}>"
    return widen(s["t"])


def _id_kind(s: dict | None) -> str:
    """int for ids that are or end in numbers, else str."""
    return "str" if not s or s["s"] or set(s["t"]) - {"str", "int", "bool"} else "int"


def _walk(parts: dict, path: str) -> dict | None:
    return _at(parts, path.split("."))


def _cells(f: Field, shapes: dict[str, dict]) -> dict[tuple[str, str], str]:
    """(table, column) -> type of the columns of a field whose type follows from the data."""
    holder = _walk(shapes, f.key) or blank()
    parts = holder["o"] if f.single and holder["o"] is not None else items_of(holder)
    out = {(f.table, dict(f.renames).get(e, e)): _kind(parts.get(e)) for e in f.extras if f.pattern not in ("time_series",)}
    out |= {(f.table, c): _kind(_walk(parts, p)) for c, p, _ in f.columns if f.pattern == "generic_list"}
    if f.pattern in ("id_ref", "nested_id_ref"):
        target = f.target or target_column(f.key, f.id_path)
        kind = _id_kind(_walk(parts, f.id_path))
        out[f.table, target] = kind
        for n in f.nested:
            out[n.table, target] = kind
            out |= {(n.table, e): _kind(items_of(parts.get(n.key)).get(e)) for e in n.extras}
    elif f.pattern == "generic_list":
        for n in f.nested:
            out |= {(n.table, c): _kind(_walk(items_of(parts.get(n.key)), p)) for c, p, _ in n.columns}
    return out


def probe(records: DataFrame, entity: str, seed: Schema | None = None, prefer_own_id: bool = True, wanted: Iterable[str] | None = None, empty_fields: bool = True) -> Schema:
    """The schema of records, completed by a seed, with the types of the wanted tables' columns (by default of all).

    Lines are read once; for typed records one aggregate is enough, which reads no column that
    cannot feed a wanted table.  ``empty_fields``: whether fields without any data have the tables
    that their names tell.
    """
    from nestloom.plans.compile import raw_tables

    typed = isinstance(records.schema["record"].dataType, T.StructType)
    wanted = list(wanted) if wanted is not None else None
    only = (lambda shapes: feeding(entity, shapes, wanted)) if wanted else None
    shapes = observe_table(records, only=only) if typed else observe(records)
    if not empty_fields:
        shapes = {k: s for k, s in shapes.items() if s["t"] or s["o"] or s["l"]}
    schema = classify(entity, shapes, prefer_own_id)
    kind = _id_kind(shapes.get("id"))
    schema = merge(seed, replace(schema, id_type=kind if seed is None else widen([seed.id_type, kind])))
    declared = {"bigint": "int", "string": "str", "double": "float", "boolean": "bool", "array<bigint>": "list<int>", "array<string>": "list<str>"}
    cells: dict[tuple[str, str], str] = {}
    for f in schema.fields:
        for k, t in _cells(f, shapes).items():
            cells[k] = widen_names([t, cells.get(k)])
    tables = {name: tuple((c, cells.get((name, c), declared.get(t, "str"))) for c, t in df.dtypes if c != "source_key") for name, df in raw_tables(records, schema, wanted).items()}
    return merge(seed, replace(schema, tables=tables))


def fingerprint(paths: Iterable[str]) -> str:
    """SHA-256 of the sorted names, each with a line end."""
    return hashlib.sha256("".join(f"{p}\n" for p in sorted(paths)).encode()).hexdigest()


def entity_schema(spark: SparkSession, root: str, entity: str, cache_dir: str | None = None, sample: bool = False) -> Schema:
    """The schema of an entity's files: from the cache of exactly these files, else probed, else as stored before.

    ``sample`` reads at most 25 files and 100 records of each instead of everything.
    """
    paths = jsonl.source_files(root, entity)
    stored = os.path.join(cache_dir, f"{entity}.json") if cache_dir else None
    if not paths:
        found = load(stored, entity) if stored else None
        if found is None:
            raise FileNotFoundError(f"no files and no stored schema of {entity}")
        return found
    cached = os.path.join(cache_dir, "probes", f"{entity}-{fingerprint(p[len(root.rstrip("/")) + 1 :] for p in paths)[:16]}.json") if cache_dir else None
    if cached and (found := load(cached, entity)):
        return found
    records = jsonl.read(spark, jsonl.stride(paths) if sample else paths, root)
    found = probe(jsonl.head(records) if sample else records, entity, load(stored, entity) if stored else None)
    if cached:
        store(found, cached)
        store(found, stored)
    return found
