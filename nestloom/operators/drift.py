"""Schemas that drift between the files of a stream.

Every file is reduced to a schema graph: its paths, their types and their nesting.  The graphs of
two consecutive files are matched by similarity flooding: a pair of nodes starts with the
similarity of their names and types, and passes it on to the pairs of their parents, children
and types until nothing moves.  The best consistent correspondences say which path became which;
those that the exact rule of a rename confirms are followed from file to file, so that every path
has the name under which its stream first had it, by which all files are read into one table,
cast to the widest of their types.  A path that is no rename keeps its own column.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestloom.runtime import materialize

#: Types in the order in which one wins over the others, with their bits.
TYPES = {"string": 1, "object": 2, "array": 4, "double": 8, "long": 16, "boolean": 32}
#: Movement below which flooding has converged, and the rounds after which it fails rather than go on.
STILL, ROUNDS = 1e-4, 10_000
#: Weight of names against types in the initial similarity.
NAME_WEIGHT = 0.5
_FILE = r"^(.*)/updated_date=([^/]*)/(part_[^/.]*)"


def type_bit(value: object) -> int:
    if isinstance(value, bool):
        return TYPES["boolean"]
    kinds = {str: "string", dict: "object", list: "array", float: "double", int: "long"}
    return TYPES[kinds[type(value)]]


def type_name(bits: int) -> str:
    """The type of a path whose values set these bits; '' for none."""
    return next((t for t, b in TYPES.items() if bits & b), "")


def parsed(line: str | None) -> dict | None:
    """The record in a line; None for null, blank, cut-off and non-object lines."""
    if not line or not line.strip():
        return None
    try:
        record = json.loads(line)
    except (ValueError, RecursionError):
        return None
    return record if isinstance(record, dict) else None


def walk(path: str, value: object, items: bool = False) -> Iterator[tuple[str, object]]:
    """Every path at and below ``path`` with its values other than null, [] and {}; those of arrays' items, at ``path[]``, if asked."""
    todo = [(path, value)]
    while todo:
        path, value = todo.pop()
        if value is None or value == [] or value == {}:
            continue
        if items or not path.endswith("[]"):
            yield path, value
        if isinstance(value, dict):
            todo += [(f"{path}.{k}", v) for k, v in value.items()]
        elif isinstance(value, list):
            todo += [(f"{path}[]", v) for v in value]


def file_schemas(lines: DataFrame, tops: dict[str, list[str]]) -> DataFrame:
    """``entity, stream, file_date, source_file, path, bits`` of lines (entity, source_file, line_text).

    ``tops`` lists the top fields of each entity; the path '' stands for the file itself, so that
    files without any parsable line are there too, and paths that end in [] tell the types of an
    array's items.  Types are gathered within each task first.
    """

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[str, str, str], int] = {}
            for entity, file, line in zip(batch["entity"], batch["source_file"], batch["line_text"], strict=True):
                seen.setdefault((entity, file, ""), 0)
                record = parsed(line)
                for top in tops[entity] if record else ():
                    for path, value in walk(top, record.get(top), items=True):
                        seen[entity, file, path] = seen.get((entity, file, path), 0) | type_bit(value)
            yield pd.DataFrame([(*k, v) for k, v in seen.items()], columns=["entity", "source_file", "path", "bits"])

    wanted = lines.select("entity", "source_file", "line_text").where(F.col("entity").isin(*tops) & F.col("source_file").isNotNull())
    found = wanted.mapInPandas(scan, "entity string, source_file string, path string, bits int")
    merged = found.groupBy("entity", "source_file", "path").agg(F.bit_or("bits").alias("bits"))
    place = lambda g: F.regexp_extract("source_file", _FILE, g)
    stream = F.when(place(3) != "", F.concat_ws("/", place(1), place(3))).otherwise(F.col("source_file"))
    return merged.select("entity", stream.alias("stream"), place(2).alias("file_date"), "source_file", "path", "bits")


def parent_of(path: str) -> str:
    return path.rpartition(".")[0]


def children_of(schema: dict[str, int]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for path in sorted(schema):
        if path:
            out.setdefault(parent_of(path), []).append(path)
    return out


def flood(old: dict[str, int], new: dict[str, int]) -> dict[tuple[str, str], float]:
    """Converged similarities of candidate pairs (old path, new path).

    Candidates below a candidate pair of parents are children of equal name, and vanished with
    new children.  A pair floods its parents' pair, its children's pairs, and, through the node
    of their common type, the other pairs of that type; each gets an equal share of what flows.
    """
    below_old, below_new = children_of(old), children_of(new)
    links: dict[tuple[str, str], list[tuple[str, str]]] = {}
    start: dict[tuple[str, str], float] = {}
    todo = [("", "")]
    while todo:
        pair = todo.pop()
        kids = []
        roots = [("", "")] if pair == ("", "") else [(pair[0], pair[1]), (pair[0] + "[]", pair[1] + "[]")]
        for a, b in roots:
            left, right = below_old.get(a, []), below_new.get(b, [])
            names = {p.rpartition(".")[2]: p for p in right}
            same = {p: names[n] for p in left if (n := p.rpartition(".")[2]) in names}
            kids += same.items()
            kept = set(same.values())
            kids += [(p, q) for p in left if p not in same for q in right if q not in kept] if a else []
        for p, q in kids:
            name = SequenceMatcher(None, p.rpartition(".")[2], q.rpartition(".")[2]).ratio()
            start[p, q] = NAME_WEIGHT * name + (1 - NAME_WEIGHT) * (type_name(old[p]) == type_name(new[q]))
        links[pair] = kids
        todo += kids
    score = dict(start)
    parent = {kid: pair for pair, kids in links.items() for kid in kids}
    kinds: dict[str, list[tuple[str, str]]] = {}
    for p, q in start:
        if type_name(old[p]) == type_name(new[q]):
            kinds.setdefault(type_name(old[p]), []).append((p, q))
    for _ in range(ROUNDS):
        flow = dict.fromkeys(score, 0.0)
        for pair, kids in links.items():
            for kid in kids:
                if pair in score:
                    flow[pair] += score[kid]
                    flow[kid] += score[pair] / len(kids)
        for pairs in kinds.values():
            through = sum(score[x] for x in pairs) / len(pairs)
            for x in pairs:
                flow[x] += through
        moved = {x: start[x] + score[x] + flow[x] for x in score}
        top = max(moved.values(), default=1.0) or 1.0
        moved = {x: v / top for x, v in moved.items()}
        still = max((abs(moved[x] - score[x]) for x in score), default=0) < STILL
        score = moved
        if still:
            return {x: score[x] for x in parent if x in score}
    raise RuntimeError(f"flooding has not converged in {ROUNDS} rounds")


def correspondences(old: dict[str, int], new: dict[str, int]) -> dict[str, tuple[str, float]]:
    """new path -> (old path, similarity): one to one, top down, below corresponding parents only.

    Equal names correspond; then the pairs of one type that are each other's best go first.
    """
    score = flood(old, new)
    chosen: dict[str, tuple[str, float]] = {}
    match = {"": ""}
    pairs: dict[str, list[tuple[str, str]]] = {}
    for p, q in score:
        pairs.setdefault(parent_of(q), []).append((p, q))
    todo = [""]
    while todo:
        parent = todo.pop()
        used: set[str] = set()
        options = [x for x in pairs.get(parent, []) if match.get(parent.removesuffix("[]"), "") == parent_of(x[0]).removesuffix("[]")]
        same = lambda x: x[0].rpartition(".")[2] == x[1].rpartition(".")[2]
        for p, q in sorted(options, key=lambda x: (not same(x), -score[x], x)):
            if p in used or q in chosen or not (same((p, q)) or type_name(old[p]) == type_name(new[q])):
                continue
            used.add(p)
            chosen[q], match[q] = (p, score[p, q]), p
            todo += [q, f"{q}[]"]
    return chosen


def changes(old: dict[str, int], new: dict[str, int], found: dict[str, tuple[str, float]]) -> list[tuple[str, str, str, float]]:
    """(change_kind, old_path, new_path, similarity) without what lies below a changed path.

    A correspondence of different names is a rename only if it is exact: its two paths are the
    only ones below one parent that vanished and appeared, and of one type.
    """
    out: list[tuple[str, str, str, float]] = []
    below_old, below_new = children_of(old), children_of(new)
    todo = [""]
    while todo:
        parent = todo.pop()
        left, right = set(below_old.get(parent, [])), set(below_new.get(parent, []))
        gone, fresh = sorted(left - right), sorted(right - left)
        if parent and len(gone) == len(fresh) == 1 and found.get(fresh[0], ("",))[0] == gone[0] and type_name(old[gone[0]]) == type_name(new[fresh[0]]):
            out.append(("renamed", gone[0], fresh[0], found[fresh[0]][1]))
        else:
            out += [("removed", p, "", 0.0) for p in gone] + [("added", "", p, 0.0) for p in fresh]
        for p in left & right:
            if type_name(old[p]) != type_name(new[p]):
                out.append(("retyped", p, p, found[p][1] if p in found else 0.0))
            else:
                todo += [p, f"{p}[]"]
    return out


_STREAM_ROW = "entity string, stream string, source_file string, row_kind string, change_kind string, old_path string, new_path string, similarity double, bits int"


def match_streams(schemas: DataFrame) -> DataFrame:
    """Rows of two kinds for each file of each stream: ``change`` against the file before, and ``name``.

    A ``name`` row maps new_path, as the file has it, to old_path, the name its stream first had
    for it.  Only schema rows are grouped by stream, whatever the number of its lines.
    """

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        entity, stream = pdf["entity"].iloc[0], pdf["stream"].iloc[0]
        before: dict[str, int] | None = None
        first: dict[str, str] = {}
        for (_, file), rows in pdf.groupby(["file_date", "source_file"], sort=True):
            held = {p: b for p, b in zip(rows["path"], rows["bits"], strict=True) if p}
            now = {p: b for p, b in held.items() if not p.endswith("[]")}
            if before is not None:
                found = changes(before, now, correspondences(before, now))
                out += [(entity, stream, file, "change", *c, 0) for c in found]
                first = carried(now, before, {new: old for kind, old, new, _ in found if kind == "renamed"}, first)
            else:
                first = {q: q for q in now}
            out += [(entity, stream, file, "name", "", _first_name(q, first), q, 1.0, b) for q, b in held.items()]
            before = now
        return pd.DataFrame(out, columns=[c.split()[0] for c in _STREAM_ROW.split(", ")])

    return schemas.groupBy("entity", "stream").applyInPandas(match, _STREAM_ROW)


def _split(path: str) -> tuple[str, str, str]:
    """(the path it is below, '[]' if as an item, its last name)."""
    parent, _, leaf = path.rpartition(".")
    bare = parent
    while bare.endswith("[]"):
        bare = bare[:-2]
    return bare, parent[len(bare) :], leaf


def _first_name(path: str, first: dict[str, str]) -> str:
    bare = path
    while bare.endswith("[]"):
        bare = bare[:-2]
    return first.get(bare, bare) + path[len(bare) :]


def carried(now: dict[str, int], before: dict[str, int], renamed: dict[str, str], first: dict[str, str]) -> dict[str, str]:
    """The first name of each path of a file, of those (``first``) of the file before.

    A path goes on under the first name of the path it was renamed from, or else of the path of
    its own name below the path that its parent was.  All others are new: they are named after
    themselves, with a number behind if a path of this file goes on under that name.
    """
    was: dict[str, str] = {}
    out: dict[str, str] = {}
    shortest_first = sorted(now, key=lambda q: (len(q), q))
    for q in shortest_first:
        parent, items, leaf = _split(q)
        old = renamed.get(q) or (q if not parent else f"{was[parent]}{items}.{leaf}" if parent in was else "")
        if old in before:
            was[q], out[q] = old, first[old]
    taken = set(out.values())
    for q in shortest_first:
        if q not in out:
            parent, items, leaf = _split(q)
            name = f"{out.get(parent, parent)}{items}.{leaf}" if parent else q
            out[q] = next(n for n in (name, *(f"{name}_{k}" for k in range(2, len(now) + 3))) if n not in taken)
            taken.add(out[q])
    return out


def schema_changes(matched: DataFrame) -> DataFrame:
    """``entity, source_file, change_kind, old_path, new_path, similarity`` of all files but the first of each stream."""
    return matched.where("row_kind = 'change'").select("entity", "source_file", "change_kind", "old_path", "new_path", "similarity")


def unified_columns(matched: DataFrame, entity: str, top: str) -> list[tuple[str, str, str]]:
    """(path below ``top`` without [], column, type) of all values that the files hold there; '' stands for ``top`` or its items.

    A column has the widest type of its path in all files; text, arrays and objects come as
    strings.  Paths that only ever hold objects with parts have no column of their own.  Column
    names are the parts joined by underscores, with a number behind where two paths would share
    one.  The result is schema, not data: it has one entry a path.
    """
    names = matched.where((F.col("row_kind") == "name") & (F.col("entity") == entity) & _at_or_below("old_path", top))
    bits: dict[str, int] = {}
    for r in names.groupBy("old_path").agg(F.bit_or("bits").alias("bits")).collect():
        path = r["old_path"][len(top) :]
        held = r["bits"] & ~TYPES["array"] if path in ("", "[]") else r["bits"]
        path = path.removeprefix("[]").removeprefix(".")
        if "[]" not in path:  # what inner arrays hold is part of their text
            bits[path] = bits.get(path, 0) | (held & ~TYPES["object"] if path == "" else held)
    parents = {".".join(p.split(".")[:n]) for p in bits for n in range(1, p.count(".") + 1)}
    out, used = [], set()
    for path in sorted(bits):
        if bits[path] & ~TYPES["object"] or path and path not in parents:
            name = f"{top}_{path}".replace(".", "_") if path else top
            column = next(n for n in (name, *(f"{name}_{k}" for k in range(2, len(bits) + 3))) if n.lower() not in used)
            used.add(column.lower())
            kind = type_name(bits[path])
            out.append((path, column, kind if kind in ("double", "long", "boolean") else "string"))
    return out


def _at_or_below(path: str, top: str) -> Column:
    return (F.col(path) == top) | F.col(path).startswith(f"{top}.") | F.col(path).startswith(f"{top}[]")


def _cell(value: object, kind: str) -> str:
    if isinstance(value, str):
        return value
    if isinstance(value, bool) and kind in ("double", "long"):
        return "1" if value else "0"
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def unify(lines: DataFrame, matched: DataFrame, entity: str, top: str) -> DataFrame:
    """One table of all files of an entity: ``record_id, source_file, item_pos`` and a column for each path below ``top``.

    Columns carry the first name of a path (dots become underscores) and the widest of its types;
    text, arrays and objects come as compact JSON strings, booleans among numbers as 1 and 0.  A
    list gives one row an item, anything else one row at position 0; what is no object stands in a
    column named ``top``.  Nulls and items without any value give no row, an empty table gives
    none.  ``lines`` has record_id, entity, source_file and line_text.

    A line is parsed into its wide row where it is read; what joins it is the renames of its file.
    """
    columns = unified_columns(matched, entity, top)
    place = {path: i for i, (path, _, _) in enumerate(columns)}
    kinds = [kind for _, _, kind in columns]

    def cells(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for record_id, file, line, new, old in zip(batch["record_id"], batch["source_file"], batch["line_text"], batch["new"], batch["old"], strict=True):
                held = (parsed(line) or {}).get(top)
                names = dict(zip(new, old, strict=True)) if new is not None else {}
                items = held if isinstance(held, list) else [held]
                root = f"{top}[]" if isinstance(held, list) else top
                for pos, item in enumerate(items):
                    row: list[str | None] = [None] * len(kinds)
                    for path, value in walk(root, item, items=True):
                        inner = path[len(root) :]
                        if "[]" not in inner:
                            i = place.get(names.get(path, path)[len(top) :].removeprefix("[]").removeprefix("."))
                            if i is not None and not (inner == "" and isinstance(value, dict)):
                                row[i] = _cell(value, kinds[i])
                    if any(c is not None for c in row):
                        out.append((record_id, file, pos, *row))
            yield pd.DataFrame(out, columns=["record_id", "source_file", "item_pos", *(f"c{i}" for i in range(len(kinds)))])

    rows = lines.where((F.col("entity") == entity) & F.col("source_file").isNotNull()).select(F.col("record_id").cast("string"), "source_file", "line_text")
    names = matched.where((F.col("row_kind") == "name") & (F.col("entity") == entity) & (F.col("new_path") != F.col("old_path")) & _at_or_below("new_path", top))
    # one row a file with renames; Spark broadcasts it as long as it is small, and shuffles beyond
    renames = names.groupBy("source_file").agg(F.collect_list(F.struct("new_path", "old_path")).alias("r")).select("source_file", "r.new_path", "r.old_path").toDF("source_file", "new", "old")
    found = rows.join(renames, "source_file", "left").mapInPandas(cells, ", ".join(["record_id string, source_file string, item_pos int", *(f"c{i} string" for i in range(len(kinds)))]))
    casts = {"long": "bigint", "double": "double", "boolean": "boolean"}
    typed = [(F.col(f"c{i}").try_cast(casts[kind]) if kind in casts else F.col(f"c{i}")).alias(column) for i, (_, column, kind) in enumerate(columns)]
    return found.select(F.col("record_id").cast("long"), "source_file", "item_pos", *typed)


def read_drifting(lines: DataFrame, tops: dict[str, list[str]]) -> DataFrame:
    """The matched streams of ``lines``, kept for the reports and tables made of them."""
    return materialize(match_streams(file_schemas(lines, tops)), "matched-streams")
