"""Queries of the general training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestloom.functions.ids import id_number
from nestloom.operators import drift, hierarchy, orphans, snapshots, unnest
from nestloom.runtime import allow_repeated_keys, table, union_all

_BLANKS = " \t\n\r 　"


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works added, removed or changed against the month before."""
    df = table(spark, sf_dir, "works_snapshot")
    state = [
        F.btrim("title", F.lit(_BLANKS)), F.col("work_type"), F.col("publication_year"), F.col("cited_by_count"), F.col("is_retracted"),
        id_number(F.col("source_id")), F.array_sort(F.array_distinct(F.array_compact(F.coalesce("indexed_in", F.array().cast("array<string>"))))),
    ]
    found = snapshots.snapshot_changes(df, id_number(F.col("id"), "w"), F.col("snapshot_date"), F.trim("updated_date"), state)
    return found.select(F.col("snapshot").alias("snapshot_date"), F.col("key").alias("work_id"), "change_kind")


def _numbers(name: str, letter: str) -> Column:
    return F.transform(name, lambda x: id_number(x, letter))


def _other_than(own: Column) -> Callable[[Column], Column]:
    return lambda x: x.isNotNull() & (x != own)


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    works, authors, dead = (table(spark, sf_dir, t) for t in ("works", "authors", "deleted_ids"))
    fields = {
        "referenced_works": ("works", _numbers("referenced_works", "w")),
        "related_works": ("works", _numbers("related_works", "w")),
        "corresponding_author_ids": ("authors", _numbers("corresponding_author_ids", "a")),
    }
    facts = [
        orphans.key_facts(kind, df, id_number(F.col("id"), letter), F.col("loaded_at"), dead.where(F.col("entity") == kind).select(id_number(F.col("id"), letter).alias("key"), "deleted_at"))
        for kind, letter, df in (("works", "w", works), ("authors", "a", authors))
    ]
    refs = orphans.references(works, id_number(F.col("id"), "w"), F.col("loaded_at"), fields)
    return orphans.orphan_references(refs, facts[0].unionByName(facts[1]))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference of a work whose target is deleted, missing or late."""
    return _orphans(spark, sf_dir).select("field_name", "load_period", F.col("source_key").alias("work_id"), F.col("target_key").alias("target_id"), "orphan_kind")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per field, month and kind."""
    return orphans.orphan_report(_orphans(spark, sf_dir))


def _parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    concepts, publishers, institutions = (table(spark, sf_dir, t) for t in ("concepts", "publishers", "institutions"))
    node = {"concepts": id_number(F.col("id"), "c"), "publishers": id_number(F.col("id"), "p"), "institutions": id_number(F.col("id"), "i")}
    above = F.array_compact(F.transform(F.col("ancestors")["id"], lambda x: id_number(x, "c")))
    stated = [concepts.select(F.lit("concepts").alias("tree"), node["concepts"].alias("node"), F.get(above, 0).alias("parent"))]
    for name, letter, df in (("publishers", "p", publishers), ("institutions", "i", institutions)):
        own = node[name]
        others = F.filter(_numbers("lineage", letter), _other_than(own))
        stated.append(df.select(F.lit(name).alias("tree"), own.alias("node"), F.get(others, 0).alias("parent")))
    related = institutions.select(node["institutions"].alias("own"), F.explode("associated_institutions").alias("r"))
    related = related.select("own", id_number(F.col("r.id"), "i").alias("other"), F.lower(F.btrim("r.relationship", F.lit(_BLANKS))).alias("relation")).where("own != other")
    stated.append(related.where("relation = 'parent'").select(F.lit("institutions").alias("tree"), F.col("own").alias("node"), F.col("other").alias("parent")))
    stated.append(related.where("relation = 'child'").select(F.lit("institutions").alias("tree"), F.col("other").alias("node"), F.col("own").alias("parent")))
    nodes = [df.select(F.lit(name).alias("tree"), node[name].alias("node")) for name, df in (("concepts", concepts), ("publishers", publishers), ("institutions", institutions))]
    return hierarchy.single_parents(union_all(nodes), union_all(stated))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root and depth of every concept, publisher and institution; those caught in loops have depth -1."""
    found = hierarchy.hierarchy(_parents(spark, sf_dir), with_path=False)
    return found.select(F.col("tree").alias("entity"), F.col("node").alias("node_id"), F.col("root").alias("root_id"), F.col("depth").alias("node_depth"))


def p4_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full path of every node, from its root; null for nodes caught in loops."""
    found = hierarchy.hierarchy(_parents(spark, sf_dir))
    return found.select(F.col("tree").alias("entity"), F.col("node").alias("node_id"), F.array_join(F.col("path").cast("array<string>"), "/").alias("node_path"))


def p4_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a node and a node below it, with their distance."""
    found = hierarchy.descendants(hierarchy.hierarchy(_parents(spark, sf_dir)))
    return found.select(F.col("tree").alias("entity"), F.col("ancestor").alias("ancestor_id"), F.col("node").alias("node_id"), "distance")


DRIFTING = {"works": ["ids", "counts_by_year"], "institutions": ["topic_share"]}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields added, removed, renamed and retyped from file to file of each stream."""
    matched = drift.match_streams(drift.file_schemas(table(spark, sf_dir, "raw_records"), DRIFTING))
    return drift.schema_changes(matched).drop("similarity")


def _unified(entity: str, top: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = table(spark, sf_dir, "raw_records")
        return drift.unify(lines, drift.read_drifting(lines, DRIFTING), entity, top)

    query.__doc__ = f"All files' {top} of {entity} in one table, under each field's first name and widest type."
    return query


_PARTS = [
    unnest.Child(
        "authorships", "author", (("author_position", "string"), ("raw_author_name", "string"), ("author.display_name", "string")),
        (unnest.Child("institutions", "", (("display_name", "string"), ("lineage", "array<string>"))),),
    ),
    unnest.Child("locations", "source", (("is_oa", "boolean"), ("is_primary", "boolean"), ("license", "string"), ("version", "string"), ("source.display_name", "string"), ("source.host.id", "string"))),
    unnest.Child("topics", "", (("score", "double"), ("count", "int"), ("display_name", "string"), ("subfield.id", "string"), ("subfield.parent.id", "string"), ("subfield.parent.parent.id", "string"))),
    unnest.Child("grants", "funder", (("award_id", "string"),)),
]
# the grants with all their scalars
_TYPED_PARTS = [*_PARTS[:3], replace(_PARTS[3], scalars=(*_PARTS[3].scalars, ("funder.display_name", "string")))]


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    allow_repeated_keys()
    return table(spark, sf_dir, "raw_records").where("entity = 'works'").select("record_id", F.try_parse_json("line_text").alias("record"))


def _subtypes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return unnest.variant_tables(_nested(spark, sf_dir), F.col("record_id"), F.col("record"), *_TYPED_PARTS)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of the nested lists of works lines, tied to its record and parent: what all typed tables share."""
    return unnest.reunited(spark, _subtypes(spark, sf_dir)).select("record_id", "child_table", "parent_pos", "item_pos", "item_key")


def p7_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each structural variant occurs in each child table."""
    return unnest.reunited(spark, _subtypes(spark, sf_dir)).groupBy("child_table", "variant").agg(F.count("*").alias("n_items"))


def p7_subtypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all typed tables with their scalars."""
    found = unnest.reunited(spark, _subtypes(spark, sf_dir), with_scalars=True)
    return found.withColumn(unnest.MISFITS, F.to_json(unnest.MISFITS) if unnest.MISFITS in found.columns else F.lit(None).cast("string"))


def p7_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same child rows from the typed columns of works; the record is the work's number and arrival."""
    works = table(spark, sf_dir, "works").withColumn("_record", unnest.from_rows(None, [c.name for c in _PARTS]))
    found = unnest.reunited(spark, unnest.variant_tables(works, F.col("id"), F.col("_record"), *_TYPED_PARTS))
    return found.select(F.col("record_id").alias("id"), "child_table", "parent_pos", "item_pos", "item_key")


QUERIES = {
    "p1_found": p1_found, "p1_report": p1_report, "p3_found": p3_found, "p3_ids": _unified("works", "ids"), "p3_counts_by_year": _unified("works", "counts_by_year"),
    "p3_topic_share": _unified("institutions", "topic_share"), "p4_found": p4_found, "p4_paths": p4_paths, "p4_descendants": p4_descendants, "p6_found": p6_found,
    "p7_found": p7_found, "p7_variants": p7_variants, "p7_subtypes": p7_subtypes, "p7_typed": p7_typed,
}

_NUM = r"""try_cast(regexp_extract({0}, '(?:^|[^A-Za-z0-9])[{1}]([0-9]+)', 1) AS BIGINT)"""


def _num(col: str, letters: str) -> str:
    return _NUM.format(col, letters)


_P1_CASES = f"""
WITH w AS (SELECT {_num("id", "wW")} AS k, * EXCLUDE (id) FROM works WHERE {_num("id", "wW")} IS NOT NULL),
arrived AS (SELECT k, min(loaded_at) AS a, max(loaded_at) AS l, 'works' AS e FROM w GROUP BY k
  UNION ALL SELECT {_num("id", "aA")} AS k, min(loaded_at), max(loaded_at), 'authors' FROM authors WHERE {_num("id", "aA")} IS NOT NULL GROUP BY 1),
dead AS (SELECT entity AS e, {_num("id", "wWaA")} AS k, max(deleted_at) AS d FROM deleted_ids GROUP BY 1, 2),
refs AS (SELECT DISTINCT f, e, k, t FROM (
  SELECT 'referenced_works' AS f, 'works' AS e, k, {_num("x", "wW")} AS t FROM (SELECT k, unnest(referenced_works) AS x FROM w)
  UNION ALL SELECT 'related_works', 'works', k, {_num("x", "wW")} FROM (SELECT k, unnest(related_works) AS x FROM w)
  UNION ALL SELECT 'corresponding_author_ids', 'authors', k, {_num("x", "aA")} FROM (SELECT k, unnest(corresponding_author_ids) AS x FROM w)) WHERE t IS NOT NULL),
cases AS (SELECT f AS field_name, strftime(src.a, '%Y-%m') AS load_period, refs.k AS work_id, refs.t AS target_id,
  CASE WHEN dead.k IS NOT NULL AND (tgt.k IS NULL OR tgt.l <= dead.d) THEN 'deleted' WHEN tgt.k IS NULL THEN 'missing' WHEN tgt.a > src.a THEN 'late' END AS orphan_kind
  FROM refs JOIN arrived src ON src.e = 'works' AND src.k = refs.k LEFT JOIN arrived tgt ON tgt.e = refs.e AND tgt.k = refs.t LEFT JOIN dead ON dead.e = refs.e AND dead.k = refs.t)
"""

_P4 = f"""
WITH RECURSIVE nodes AS (SELECT DISTINCT * FROM (SELECT 'concepts' AS e, {_num("id", "cC")} AS n FROM concepts UNION ALL SELECT 'publishers', {_num("id", "pP")} FROM publishers
  UNION ALL SELECT 'institutions', {_num("id", "iI")} FROM institutions) WHERE n IS NOT NULL),
related AS (SELECT {_num("id", "iI")} AS own, {_num("r.id", "iI")} AS other, lower(trim(r.relationship, '{_BLANKS}')) AS relation FROM (SELECT id, unnest(associated_institutions) AS r FROM institutions)),
stated AS (SELECT 'concepts' AS e, {_num("id", "cC")} AS n, list_filter([{_num("x.id", "cC")} FOR x IN ancestors], lambda y: y IS NOT NULL)[1] AS p FROM concepts
  UNION ALL SELECT 'publishers', {_num("id", "pP")}, list_filter([{_num("x", "pP")} FOR x IN lineage], lambda y: y IS NOT NULL AND y != {_num("id", "pP")})[1] FROM publishers
  UNION ALL SELECT 'institutions', {_num("id", "iI")}, list_filter([{_num("x", "iI")} FOR x IN lineage], lambda y: y IS NOT NULL AND y != {_num("id", "iI")})[1] FROM institutions
  UNION ALL SELECT 'institutions', own, other FROM related WHERE relation = 'parent' AND own != other
  UNION ALL SELECT 'institutions', other, own FROM related WHERE relation = 'child' AND own != other),
up AS (SELECT s.e, s.n, min(s.p) AS p FROM stated s JOIN nodes x ON x.e = s.e AND x.n = s.p WHERE s.n IS NOT NULL GROUP BY ALL),
links AS (SELECT nodes.e, nodes.n, up.p FROM nodes LEFT JOIN up ON up.e = nodes.e AND up.n = nodes.n),
walk AS (SELECT e, n AS start, n AS cur, p AS next, [n] AS seen, false AS looped FROM links
  UNION ALL SELECT w.e, w.start, l.n, l.p, list_append(w.seen, l.n), list_contains(w.seen, l.n) FROM walk w JOIN links l ON l.e = w.e AND l.n = w.next WHERE NOT w.looped),
ends AS (SELECT * FROM walk WHERE next IS NULL OR looped),
tree AS (SELECT e AS entity, start AS node_id, CASE WHEN looped THEN list_min(list_slice(seen, list_position(seen, cur), len(seen))) ELSE cur END AS root_id, CASE WHEN looped THEN -1 ELSE len(seen) - 1 END AS node_depth, seen, looped FROM ends)
"""

_SHORT = "upper(regexp_extract({0}, '(?:^|[^A-Za-z0-9])([A-Za-z])([0-9]+)', 1)) || CAST(try_cast(regexp_extract({0}, '(?:^|[^A-Za-z0-9])([A-Za-z])([0-9]+)', 2) AS BIGINT) AS VARCHAR)"


def _p7_part(name: str, key: str) -> str:
    return f"""SELECT id, '{name}' AS child_table, -1 AS parent_pos, pos AS item_pos, coalesce({_SHORT.format(key)}, '') AS item_key
FROM (SELECT id, unnest({name}) AS x, CAST(generate_subscripts({name}, 1) - 1 AS INTEGER) AS pos FROM works) WHERE x IS NOT NULL"""


def _resolved(x: str) -> str:
    return f"""CASE WHEN json_type({x}) = 'VARCHAR' AND regexp_matches({x} ->> '$', '^\\s*([\\[{{"]|null\\s*$)') AND json_valid({x} ->> '$') THEN CAST({x} ->> '$' AS JSON) ELSE {x} END"""


def _at(name: str) -> str:
    return f"(j -> '{name}')"


def _key(x: str) -> str:
    text = f"CASE json_type({x}) WHEN 'VARCHAR' THEN {x} ->> '$' WHEN 'OBJECT' THEN {x} ->> '$.id' END"
    return f"coalesce({_SHORT.format(f'({text})')}, '')"


_ITEMS = f"""CASE WHEN json_type(held) = 'ARRAY' THEN CAST(held AS JSON[]) WHEN json_type(held) = 'OBJECT' OR json_type(held) = 'VARCHAR' AND {_SHORT.format("(held ->> '$')")} IS NOT NULL THEN [held] END"""
_P7_ITEMS = f"""
WITH l AS (SELECT record_id, CASE WHEN json_valid(line_text) AND json_type(line_text) = 'OBJECT' THEN CAST(line_text AS JSON) END AS j FROM raw_records WHERE entity = 'works'),
tops AS ({" UNION ALL ".join(f"SELECT record_id, '{c}' AS child_table, {_resolved(_at(c))} AS held FROM l" for c in ("authorships", "locations", "topics", "grants"))}),
t AS (SELECT record_id, child_table, -1 AS parent_pos, unnest(items) AS raw, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS item_pos FROM (SELECT *, {_ITEMS} AS items FROM tops)),
first AS (SELECT * EXCLUDE (raw), {_resolved("raw")} AS item FROM t),
inner_lists AS (SELECT record_id, item_pos AS parent_pos, {_resolved("(item -> 'institutions')")} AS held FROM first WHERE child_table = 'authorships' AND json_type(item) = 'OBJECT'),
second AS (SELECT record_id, 'institutions' AS child_table, parent_pos, unnest(items) AS raw, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS item_pos FROM (SELECT *, {_ITEMS} AS items FROM inner_lists)),
everything AS (SELECT record_id, child_table, parent_pos, item_pos, item FROM first UNION ALL SELECT record_id, child_table, parent_pos, item_pos, {_resolved("raw")} FROM second),
keyed AS (SELECT *, CASE WHEN child_table IN ('institutions', 'topics') OR json_type(item) = 'VARCHAR' THEN item
  ELSE CASE child_table WHEN 'authorships' THEN {_resolved("(item -> 'author')")} WHEN 'locations' THEN {_resolved("(item -> 'source')")} ELSE {_resolved("(item -> 'funder')")} END END AS node
  FROM everything WHERE item IS NOT NULL AND json_type(item) != 'NULL')
"""

# every path with a value, its type and the item it is in, of the lines of raw_records
_P3_CELLS = """
lines AS (SELECT record_id, entity, source_file, regexp_extract(source_file, 'updated_date=([^/]*)/', 1) AS d, regexp_extract(source_file, '/(part_[^/.]*)', 1) AS s,
    CASE WHEN json_valid(line_text) AND json_type(line_text) = 'OBJECT' THEN line_text END AS t FROM raw_records WHERE source_file IS NOT NULL AND entity IN ('works', 'institutions')),
tops AS (SELECT * EXCLUDE (t), CASE entity WHEN 'works' THEN json_object('ids', t -> '$.ids', 'counts_by_year', t -> '$.counts_by_year') ELSE json_object('topic_share', t -> '$.topic_share') END AS j FROM lines WHERE t IS NOT NULL),
nodes AS (SELECT record_id, entity, source_file, substr(n.fullkey, 3) AS k, n.type, n.value AS v FROM tops, json_tree(tops.j) n WHERE n.fullkey != '$' AND n.type != 'NULL' AND CAST(n.value AS VARCHAR) NOT IN ('{}', '[]')),
cells AS (SELECT *, regexp_replace(k, '\\[[0-9]+\\]', '[]', 'g') AS path, coalesce(try_cast(regexp_extract(k, '^[^.\\[]*\\[([0-9]+)\\]', 1) AS INTEGER), 0) AS item_pos,
    CASE type WHEN 'VARCHAR' THEN 1 WHEN 'OBJECT' THEN 2 WHEN 'ARRAY' THEN 3 WHEN 'DOUBLE' THEN 4 WHEN 'BOOLEAN' THEN 6 ELSE 5 END AS kind FROM nodes),
files AS (SELECT *, row_number() OVER (PARTITION BY entity, s ORDER BY d, source_file) AS i FROM (SELECT DISTINCT entity, s, d, source_file FROM lines)),
paths AS (SELECT f.entity, f.s, f.i, c.path, min(c.kind) AS kind FROM files f JOIN cells c ON c.entity = f.entity AND c.source_file = f.source_file WHERE c.path NOT LIKE '%[]' GROUP BY ALL),
sides AS (SELECT entity, s, i, path, max(o) AS o, max(n) AS n FROM (SELECT entity, s, i, path, NULL AS o, kind AS n FROM paths UNION ALL
    SELECT p.entity, p.s, p.i + 1, p.path, p.kind, NULL FROM paths p JOIN files f ON f.entity = p.entity AND f.s = p.s AND f.i = p.i + 1) GROUP BY ALL),
touched AS (SELECT *, CASE WHEN path LIKE '%.%' THEN regexp_replace(path, '\\.[^.]*$', '') ELSE '' END AS up FROM sides WHERE i > 1 AND o IS DISTINCT FROM n),
clean AS (SELECT * FROM touched t WHERE NOT EXISTS (FROM touched a WHERE a.entity = t.entity AND a.s = t.s AND a.i = t.i AND (starts_with(t.path, a.path || '.') OR starts_with(t.path, a.path || '[]')))),
kin AS (SELECT entity, s, i, up, up != '' AND count(*) FILTER (WHERE n IS NULL) = 1 AND count(*) FILTER (WHERE o IS NULL) = 1 AND max(o) FILTER (WHERE n IS NULL) = max(n) FILTER (WHERE o IS NULL) AS renames,
    max(path) FILTER (WHERE n IS NULL) AS gone, max(path) FILTER (WHERE o IS NULL) AS fresh FROM clean WHERE o IS NULL OR n IS NULL GROUP BY entity, s, i, up),
changes AS (SELECT entity, s, i, 'retyped' AS change_kind, path AS old_path, path AS new_path FROM clean WHERE o IS NOT NULL AND n IS NOT NULL
  UNION ALL SELECT entity, s, i, 'renamed', gone, fresh FROM kin WHERE renames
  UNION ALL SELECT c.entity, c.s, c.i, CASE WHEN n IS NULL THEN 'removed' ELSE 'added' END, CASE WHEN n IS NULL THEN path ELSE '' END, CASE WHEN n IS NULL THEN '' ELSE path END
    FROM clean c JOIN kin g ON g.entity = c.entity AND g.s = c.s AND g.i = c.i AND g.up = c.up WHERE NOT g.renames AND (o IS NULL OR n IS NULL)),
"""


def _p3_table(entity: str, top: str, columns: dict[str, str]) -> str:
    """SQL of a unified table with the columns (by path below the top field) that the data of the tests have."""
    casts = {"bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
    value = "CASE WHEN c.type = 'VARCHAR' THEN c.v ->> '$' ELSE CAST(c.v AS VARCHAR) END"
    cells = [f"max(CASE WHEN name = '{p}' THEN {f'try_cast({value} AS {casts[t]})' if t in casts else value} END) AS {(top + '_' + p).replace('.', '_')}" for p, t in columns.items()]
    return f"""
WITH RECURSIVE {_P3_CELLS}
prior AS (SELECT p.entity, p.s, p.i, p.path, coalesce(any_value(r.old_path || substr(p.path, length(r.new_path) + 1)), p.path) AS was FROM paths p LEFT JOIN changes r ON r.change_kind = 'renamed' AND r.entity = p.entity AND r.s = p.s AND r.i = p.i
    AND (p.path = r.new_path OR starts_with(p.path, r.new_path || '.') OR starts_with(p.path, r.new_path || '[]')) GROUP BY p.entity, p.s, p.i, p.path),
names AS (SELECT entity, s, i, path, path AS name FROM prior WHERE i = 1
  UNION ALL SELECT p.entity, p.s, p.i, p.path, coalesce(max(n.name) FILTER (WHERE n.path = p.was), max(n.name || regexp_extract(p.was, '(\\[\\])*\\.[^.]*$')) FILTER (WHERE n.path = regexp_replace(p.was, '(\\[\\])*\\.[^.]*$', '')), p.path)
    FROM prior p JOIN names n ON n.entity = p.entity AND n.s = p.s AND n.i = p.i - 1 GROUP BY p.entity, p.s, p.i, p.path),
named AS (SELECT f.source_file, n.path, regexp_replace(substr(n.name, {len(top) + 1}), '^(\\[\\])?\\.?', '') AS name FROM names n JOIN files f ON f.entity = n.entity AND f.s = n.s AND f.i = n.i
    WHERE n.entity = '{entity}' AND starts_with(n.path, '{top}') AND n.path != '{top}' AND NOT contains(regexp_replace(n.path, '^[^.\\[]*\\[\\]', ''), '[]'))
SELECT c.record_id, c.source_file, c.item_pos, {', '.join(cells)}
FROM cells c JOIN named n ON n.source_file = c.source_file AND n.path = c.path WHERE c.entity = '{entity}' GROUP BY ALL"""


_P3_TABLES = {
    "p3_ids": ("works", "ids", {"doi": "", "graph": "", "mag": "bigint", "pmid": "", "rank_score": "double"}),
    "p3_counts_by_year": ("works", "counts_by_year", {"cited_by_count": "", "is_final": "boolean", "oa_count": "bigint", "origin": "", "origin.id": "", "year": "bigint"}),
    "p3_topic_share": ("institutions", "topic_share", {
        "domain.display_name": "", "domain.id": "", "domain.legacy_id": "bigint", "field.id": "", "id": "", "is_top": "boolean", "label": "", "rank": "bigint", "score": "double",
        "subfield": "", "subfield.id": "", "tags": "", "value": "double",
    }),
}


ORACLE = {
    "p3_found": f"WITH {_P3_CELLS.rstrip().rstrip(',')} SELECT c.entity, f.source_file, change_kind, old_path, new_path FROM changes c JOIN files f USING (entity, s, i)",
    **{name: _p3_table(*parts) for name, parts in _P3_TABLES.items()},
    "p7_found": _P7_ITEMS + f"SELECT record_id, child_table, parent_pos, item_pos, {_key('node')} AS item_key FROM keyed",
    "p7_typed": " UNION ALL ".join(_p7_part(n, k) for n, k in (("authorships", "x.author.id"), ("locations", "x.source.id"), ("topics", "x.id"), ("grants", "x.funder"))) + f"""
UNION ALL SELECT id, 'institutions', pos, ipos, coalesce({_SHORT.format("y.id")}, '') FROM (SELECT id, pos, unnest(x.institutions) AS y, CAST(generate_subscripts(x.institutions, 1) - 1 AS INTEGER) AS ipos
FROM (SELECT id, unnest(authorships) AS x, CAST(generate_subscripts(authorships, 1) - 1 AS INTEGER) AS pos FROM works) WHERE x IS NOT NULL) WHERE y IS NOT NULL""",
    "p4_found": _P4 + "SELECT entity, node_id, root_id, CAST(node_depth AS INTEGER) AS node_depth FROM tree",
    "p4_paths": _P4 + "SELECT entity, node_id, CASE WHEN NOT looped THEN array_to_string(list_reverse(seen), '/') END AS node_path FROM tree",
    "p4_descendants": _P4 + """SELECT entity, seen[i + 1] AS ancestor_id, node_id, CAST(i AS INTEGER) AS distance
FROM (SELECT *, unnest(range(1, len(seen))) AS i FROM tree WHERE NOT looped)""",
    "p1_found": _P1_CASES + "SELECT * FROM cases WHERE orphan_kind IS NOT NULL",
    "p1_report": _P1_CASES + "SELECT field_name, load_period, orphan_kind, count(*) AS n_references, count(DISTINCT target_id) AS n_targets FROM cases WHERE orphan_kind IS NOT NULL GROUP BY ALL",
    "p6_found": f"""
WITH r AS (SELECT snapshot_date AS s, {_num("id", "wW")} AS k, trim(updated_date) AS u, trim(title, '{_BLANKS}') AS t, work_type AS w, publication_year AS y,
  cited_by_count AS c, is_retracted AS x, {_num("source_id", "sS")} AS src, list_sort(list_distinct(coalesce(indexed_in, []))) AS ii FROM works_snapshot),
d AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY s, k ORDER BY u DESC NULLS LAST) = 1),
n AS (SELECT s, lead(s) OVER (ORDER BY s) AS nx FROM (SELECT DISTINCT s FROM r)),
p AS (SELECT n.nx AS s, d.* EXCLUDE (s) FROM d JOIN n USING (s) WHERE nx IS NOT NULL),
c AS (SELECT d.* FROM d JOIN n ON n.nx = d.s)
SELECT coalesce(c.s, p.s) AS snapshot_date, coalesce(c.k, p.k) AS work_id,
  CASE WHEN p.k IS NULL THEN 'added' WHEN c.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM c FULL JOIN p ON c.s = p.s AND c.k = p.k
WHERE p.k IS NULL OR c.k IS NULL OR (c.t, c.w, c.y, c.c, c.x, c.src, c.ii) IS DISTINCT FROM (p.t, p.w, p.y, p.c, p.x, p.src, p.ii)""",
}
