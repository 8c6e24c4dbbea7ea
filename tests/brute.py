"""Plain Python versions of the operators, to hold results against."""

import json
import re
from collections import defaultdict

ID = re.compile(r"(?:^|[^A-Za-z0-9])([A-Za-z])([0-9]+)")


def short(x):
    m = ID.search(x) if isinstance(x, str) else None
    return m[1].upper() + str(int(m[2])) if m else None


def record(line):
    try:
        v = json.loads(line or "")
    except ValueError:
        return None
    return v if isinstance(v, dict) else None


def drift_changes(rows, tops):
    """rows: (entity, source_file, line_text)."""
    order = ["string", "object", "array", "double", "long", "boolean"]
    kind = lambda v: {str: "string", dict: "object", list: "array", bool: "boolean", float: "double", int: "long"}[type(v)]
    files = defaultdict(lambda: defaultdict(set))
    for entity, file, line in rows:
        if entity not in tops or file is None:
            continue
        seen = files[entity, file]
        v = record(line)

        def note(path, x, seen=seen):
            if x is None or x == [] or x == {}:
                return
            if path[-1] != "[]":
                seen[path].add(kind(x))
            if isinstance(x, dict):
                for k, y in x.items():
                    note((*path, k), y)
            elif isinstance(x, list):
                for y in x:
                    note((*path, "[]"), y)

        for top in tops[entity] if v else ():
            note((top,), v.get(top))
    streams = defaultdict(list)
    for entity, file in files:
        date, name = file.split("updated_date=")[1].split("/")
        streams[entity, name].append((date, file))
    out = set()
    text = lambda p: ".".join(p).replace(".[]", "[]")
    for (entity, _), parts in streams.items():
        parts.sort()
        for (_, a), (_, b) in zip(parts, parts[1:], strict=False):
            old, new = ({p: min(t, key=order.index) for p, t in files[entity, f].items()} for f in (a, b))
            touched = {p for p in old.keys() | new.keys() if old.get(p) != new.get(p)}
            clean = [p for p in touched if not any(p[:i] in touched for i in range(1, len(p)))]
            gone, fresh = [p for p in clean if p not in new], [p for p in clean if p not in old]
            for p in clean:
                g, f = ([q for q in side if q[:-1] == p[:-1]] for side in (gone, fresh))
                swap = len(p) > 1 and len(g) == len(f) == 1 and old[g[0]] == new[f[0]]
                if p in old and p in new:
                    out.add((entity, b, "retyped", text(p), text(p)))
                elif swap:
                    out.add((entity, b, "renamed", text(g[0]), text(f[0])))
                elif p in old:
                    out.add((entity, b, "removed", text(p), ""))
                else:
                    out.add((entity, b, "added", "", text(p)))
    return out


def nested_items(record_id, line):
    v = record(line)
    out = []

    def res(x):
        if isinstance(x, str) and re.match(r'\s*([\[{"]|null\s*$)', x):
            try:
                return json.loads(x)
            except ValueError:
                pass
        return x

    def listed(x):
        x = res(x)
        if isinstance(x, list):
            return [res(y) for y in x]
        return [x] if isinstance(x, dict) or short(x) else []

    def key(x):
        x = res(x)
        return (short(x.get("id")) if isinstance(x, dict) else short(x)) or ""

    for table, part in (("authorships", "author"), ("locations", "source"), ("topics", None), ("grants", "funder")):
        for i, x in enumerate(listed(v.get(table)) if v else []):
            if x is None:
                continue
            out.append((record_id, table, -1, i, key(x.get(part) if part and isinstance(x, dict) else x)))
            if table == "authorships" and isinstance(x, dict):
                out += [(record_id, "institutions", i, j, key(y)) for j, y in enumerate(listed(x.get("institutions"))) if y is not None]
    return out
