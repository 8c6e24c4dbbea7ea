"""The logical schema of an entity: which field becomes which table, and how."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, replace

from nestloom.functions.lattice import widen, widen_names
from nestloom.functions.naming import singular
from nestloom.sources import files

VERSION = 1


@dataclass(frozen=True)
class Field:
    """One field of a record and the pattern that turns it into rows of ``table``."""

    key: str
    pattern: str
    table: str
    id_path: str = "id"
    target: str = ""
    extras: tuple[str, ...] = ()
    nested: tuple[Field, ...] = ()
    renames: tuple[tuple[str, str], ...] = ()
    single: bool = False
    #: scalar columns (column, path, type) of the main table, or flattened leaves of list items
    columns: tuple[tuple[str, str, str], ...] = ()
    flags: tuple[tuple[str, bool], ...] = ()

    @classmethod
    def parse(cls, data: dict) -> Field:
        lists = {k: tuple(tuple(x) if isinstance(x, list) else x for x in data.get(k, ())) for k in ("extras", "renames", "columns", "flags")}
        return cls(**{**data, **lists, "nested": tuple(map(cls.parse, data.get("nested", ())))})


@dataclass(frozen=True)
class Schema:
    """All fields of an entity, its id, and the types of every table's columns."""

    entity: str
    fields: tuple[Field, ...] = ()
    id_path: str = "id"
    id_type: str = "int"
    #: table -> ((column, type), ...); empty until observed
    tables: dict[str, tuple[tuple[str, str], ...]] = field(default_factory=dict)

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.to_json().encode()).hexdigest()[:16]

    @property
    def id_column(self) -> str:
        return f"{singular(self.entity)}_id"

    @property
    def main(self) -> str:
        return f"{singular(self.entity)}_main"

    def table_names(self) -> list[str]:
        """All tables in the order of their fields; nested ones after their parents."""
        out: dict[str, None] = {}
        for f in self.fields:
            out[f.table] = None
            out |= {n.table: None for n in f.nested}
        return list(out)

    def to_json(self) -> str:
        return json.dumps({"version": VERSION, **asdict(self)}, ensure_ascii=False, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Schema:
        data = json.loads(text)
        if data.pop("version", None) != VERSION:
            raise ValueError("schema of another version")
        tables = {t: tuple((c, k) for c, k in cols) for t, cols in data["tables"].items()}
        return cls(**{**data, "fields": tuple(map(Field.parse, data["fields"])), "tables": tables})


def merge_fields(seed: Field, seen: Field) -> Field:
    """The seen field with the columns that only the seed has appended."""
    extras = seen.extras + tuple(e for e in seed.extras if e not in seen.extras)
    mine = {c[0]: c for c in seen.columns}
    both = tuple((c, p, widen([t, dict((x[0], x[2]) for x in seed.columns).get(c, t)])) for c, p, t in seen.columns)
    columns = both + tuple(c for c in seed.columns if c[0] not in mine)
    nested_seed = {n.table: n for n in seed.nested}
    nested = tuple(merge_fields(nested_seed[n.table], n) if n.table in nested_seed else n for n in seen.nested)
    nested += tuple(n for n in seed.nested if n.table not in {x.table for x in seen.nested})
    return replace(seen, extras=extras, columns=columns, nested=nested)


def merge(seed: Schema | None, seen: Schema) -> Schema:
    """What was seen, completed by the seed: its fields and columns stay, and a string id stays one."""
    if seed is None:
        return seen
    old = {f.key: f for f in seed.fields}
    fields = tuple(merge_fields(old[f.key], f) if f.key in old and old[f.key].pattern == f.pattern else f for f in seen.fields)
    fields += tuple(f for f in seed.fields if f.key not in {x.key for x in seen.fields})
    tables = dict(seen.tables)
    for t, cols in seed.tables.items():
        now = dict(tables.get(t, ()))
        kept = tuple((c, widen_names([k, dict(cols).get(c)])) for c, k in now.items())
        tables[t] = kept + tuple((c, k) for c, k in cols if c not in now)
    return replace(seen, fields=fields, id_type=widen([seed.id_type, seen.id_type]), tables=tables)


def store(schema: Schema, path: str) -> None:
    """Write a schema so that a reader sees the old file or the new one, never a part."""
    files.write_text(path, schema.to_json())


def load(path: str, entity: str) -> Schema | None:
    """A stored schema; None if it is missing, unreadable, of another version or of another entity."""
    try:
        text = files.read_text(path)
        found = Schema.from_json(text) if text is not None else None
    except (ValueError, KeyError, TypeError):
        return None
    return found if found and found.entity == entity else None
