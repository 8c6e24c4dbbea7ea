"""Queries of the flattening, graph and incremental operators over the driver's tables, and their SQL.

Ids are compared as text, since whether a column of ids is numeric depends on the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestloom.functions import ids, lattice, naming
from nestloom.operators import graph
from nestloom.plans import catalog, incremental
from nestloom.plans.compile import raw_tables, table_sizes, tables
from nestloom.plans.probe import probe
from nestloom.plans.schema import Field, Schema
from nestloom.runtime import table, union_all
from nestloom.sources import jsonl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = sql


# ---- SQL of ids -------------------------------------------------------------------------------


def _number(x: str) -> str:
    return f"try_cast(nullif(regexp_extract(regexp_extract({x}, '([^/]*)$', 1), '([0-9]+)$', 1), '') AS BIGINT)"


def _own(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL AND {x} != '' THEN coalesce(CAST({_number(x)} AS VARCHAR), regexp_extract({x}, '([^/]*)$', 1)) END"


def _text_number(x: str) -> str:
    return f"CAST({_number(x)} AS VARCHAR)"


# ---- tables of nested records -----------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    df = table(spark, sf_dir, entity)
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes]
    return jsonl.read_table(df.select(*times))


def _relation(entity: str, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = _records(spark, sf_dir, entity)
        schema = probe(records, entity, wanted=[name])
        df = tables(records, schema, [name])[name].drop("source_key")
        return df.select(*[F.col(c).cast("string") if c.endswith("_id") else F.col(c) for c in df.columns])

    query.__doc__ = f"The table {name} of {entity}, by the inferred schema."
    return query


def _list_sql(entity: str, column: str, cells: str, where: str = "TRUE", id_name: str = "") -> str:
    own = id_name or f"{naming.singular(entity)}_id"
    return f"SELECT * FROM (SELECT {_own('r.id')} AS {own}, {cells} FROM (SELECT id, unnest({column}) AS x FROM {entity}) r WHERE x IS NOT NULL) WHERE {own} IS NOT NULL AND {where}"


def _entity_main(entity: str, columns: str) -> None:
    name = f"{naming.singular(entity)}_main"
    times = "strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f') AS loaded_at, " if entity != "topics" else ""
    _add(name, _relation(entity, name), f"SELECT {_own('id')} AS {naming.singular(entity)}_id, {times}{columns} FROM {entity} WHERE {_own('id')} IS NOT NULL")


_entity_main("works", "CAST(cited_by_count AS BIGINT) AS cited_by_count, doi, is_retracted, lang, CAST(publication_year AS BIGINT) AS publication_year, source_file, title, updated_date, work_type")
_entity_main("authors", "CAST(cited_by_count AS BIGINT) AS cited_by_count, display_name, orcid, updated_date, CAST(works_count AS BIGINT) AS works_count")
_entity_main("institutions", "country_code, display_name, updated_date, CAST(works_count AS BIGINT) AS works_count")
_entity_main("publishers", "display_name, updated_date, CAST(works_count AS BIGINT) AS works_count")
_entity_main("concepts", "CAST(concept_level AS BIGINT) AS concept_level, display_name, updated_date")
_entity_main("topics", "display_name, updated_date")

_LISTS = {
    ("works", "work_authorships"): ("authorships", f"{_own('x.author.id')} AS authorship_id, x.author_position", "authorship_id IS NOT NULL"),
    ("works", "work_referenced_works"): ("referenced_works", f"{_text_number('x')} AS referenced_work_id", "referenced_work_id IS NOT NULL"),
    ("works", "work_related_works"): ("related_works", f"{_text_number('x')} AS related_work_id", "related_work_id IS NOT NULL"),
    ("works", "work_corresponding_author_ids"): ("corresponding_author_ids", f"{_text_number('x')} AS corresponding_author_id_id", "corresponding_author_id_id IS NOT NULL"),
    ("works", "work_topics"): ("topics", f"{_own('x.id')} AS topic_id, x.score, CAST(x.count AS BIGINT) AS count", "topic_id IS NOT NULL"),
    ("works", "work_concepts"): ("concepts", f"{_own('x.id')} AS concept_id, x.score", "concept_id IS NOT NULL"),
    ("works", "work_keywords"): ("keywords", "CASE WHEN x.id != '' THEN regexp_extract(x.id, '([^/]*)$', 1) END AS keyword_id, x.score", "keyword_id IS NOT NULL"),
    ("works", "work_locations"): ("locations", f"{_text_number('x.source.id')} AS source_id, x.is_oa, x.is_primary, x.license, x.version", "TRUE"),
    ("works", "work_funders"): ("grants", f"{_text_number('x.funder')} AS funder_id, x.award_id AS award_id", "funder_id IS NOT NULL"),
    ("works", "work_counts_by_year"): ("counts_by_year", "CAST(x.year AS BIGINT) AS year, coalesce(CAST(x.cited_by_count AS BIGINT), 0) AS cited_by_count", "year IS NOT NULL"),
    ("authors", "author_display_name_alternatives"): ("display_name_alternatives", "x AS display_name_alternative", "display_name_alternative != ''"),
    ("authors", "author_last_known_institutions"): ("last_known_institutions", f"{_own('x.id')} AS last_known_institution_id", "last_known_institution_id IS NOT NULL"),
    ("authors", "author_affiliations"): ("affiliations", f"{_own('x.institution.id')} AS affiliation_id", "affiliation_id IS NOT NULL"),
    ("institutions", "institution_lineage"): ("lineage", f"{_text_number('x')} AS lineage_id", "lineage_id IS NOT NULL"),
    ("institutions", "institution_associated_institutions"): ("associated_institutions", f"{_own('x.id')} AS associated_institution_id, x.relationship", "associated_institution_id IS NOT NULL"),
    ("institutions", "institution_topic_share"): ("topic_share", f"{_text_number('x.id')} AS topic_id, coalesce(x.value, 0.0) AS value", "topic_id IS NOT NULL"),
    ("institutions", "institution_display_name_alternatives"): ("display_name_alternatives", "x AS display_name_alternative", "display_name_alternative != ''"),
    ("publishers", "publisher_lineage"): ("lineage", f"{_text_number('x')} AS lineage_id", "lineage_id IS NOT NULL"),
    ("publishers", "publisher_country_codes"): ("country_codes", "x AS country_code", "country_code != ''"),
    ("publishers", "publisher_alternate_titles"): ("alternate_titles", "x AS alternate_title", "alternate_title != ''"),
    ("concepts", "concept_ancestors"): ("ancestors", f"{_own('x.id')} AS ancestor_id", "ancestor_id IS NOT NULL"),
    ("concepts", "concept_related_concepts"): ("related_concepts", f"{_own('x.id')} AS related_concept_id, x.score", "related_concept_id IS NOT NULL"),
    ("topics", "topic_keywords"): ("keywords", "x AS keyword", "keyword != ''"),
}
for (_entity, _name), (_column, _cells, _where) in _LISTS.items():
    _add(_name, _relation(_entity, _name), _list_sql(_entity, _column, _cells, _where))
_add("work_authorships_institutions", _relation("works", "work_authorships_institutions"), f"""
SELECT * FROM (SELECT {_own('id')} AS work_id, {_own('x.author.id')} AS authorship_id, {_text_number('y.id')} AS institution_id
FROM (SELECT id, x, unnest(x.institutions) AS y FROM (SELECT id, unnest(authorships) AS x FROM works) WHERE x.institutions IS NOT NULL))
WHERE work_id IS NOT NULL AND authorship_id IS NOT NULL AND institution_id IS NOT NULL""")  # fmt: skip
_add("work_external_ids", _relation("works", "work_external_ids"), f"""
SELECT {_own('id')} AS work_id, source, value FROM (SELECT id, unnest(['graph', 'doi', 'mag', 'pmid']) AS source,
  unnest([ids.graph, ids.doi, CASE WHEN ids.mag != 0 THEN CAST(ids.mag AS VARCHAR) END, ids.pmid]) AS value FROM works WHERE ids IS NOT NULL)
WHERE value != '' AND {_own('id')} IS NOT NULL""")  # fmt: skip
_add("concept_external_ids", _relation("concepts", "concept_external_ids"), f"""
SELECT {_own('id')} AS concept_id, source, value FROM (SELECT id, unnest(['graph', 'wikidata']) AS source, unnest([ids.graph, ids.wikidata]) AS value FROM concepts WHERE ids IS NOT NULL)
WHERE value != '' AND {_own('id')} IS NOT NULL""")  # fmt: skip
for _key in ("subfield", "field_ref", "domain_ref"):
    _add(f"topic_{_key}s", _relation("topics", f"topic_{_key}s"), f"SELECT {_own('id')} AS topic_id, {_text_number(f'{_key}.id')} AS {_key}_id FROM topics WHERE {_number(f'{_key}.id')} IS NOT NULL")


def work_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that works give, in one pass of the classifier."""
    records = _records(spark, sf_dir, "works")
    return table_sizes(records, probe(records, "works", wanted=[]))


_add("work_tables", work_tables, " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM ({sql}) HAVING count(*) > 0" for t, sql in ORACLE.items() if t.startswith("work_")))


# ---- patterns over records made of the flat tables --------------------------------------------


def _pattern(make: Callable[[SparkSession, str], DataFrame], entity: str, field: Field, name: str = "") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = jsonl.read_table(make(spark, sf_dir))
        df = raw_tables(records, Schema(entity, (field,)), [name or field.table])[name or field.table].drop("source_key")
        loose = {c for c, _, _ in field.columns} if field.pattern == "generic_list" else set()
        return df.select(*[lattice.scalar_text(F.col(c)).alias(c) if t == "variant" else F.col(c).cast("string") if c in loose else F.col(c) for c, t in df.dtypes])

    query.__doc__ = f"The pattern {field.pattern}."
    return query


def _suppliers(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: table(spark, sf_dir, "supplier").selectExpr("concat('https://graph.example/S', s_suppkey) AS id", *columns)


_ROLE = "element_at(array('funder', 'publisher', 'institution', 'other'), cast(s_suppkey % 4 + 1 AS int))"
_add("roles", _pattern(_suppliers(f"array(named_struct('id', concat('https://graph.example/F', s_nationkey), 'role', {_ROLE}), named_struct('id', 'none', 'role', 'funder')) AS roles"), "sources", Field("roles", "roles", "source_roles")),
     "SELECT s_suppkey AS source_id, CAST(s_nationkey AS BIGINT) AS role_entity_id, (['funder', 'publisher', 'institution', 'other'])[s_suppkey % 4 + 1] AS role_type, (['F', 'P', 'I', ''])[s_suppkey % 4 + 1] AS role_prefix FROM supplier")
_add("issn", _pattern(_suppliers("array(s_name, '', NULL) AS issn"), "sources", Field("issn", "issn", "source_issns")), "SELECT s_suppkey AS source_id, s_name AS issn FROM supplier WHERE s_name != ''")
_add("apc_prices", _pattern(_suppliers("array(named_struct('price', nullif(s_suppkey % 7, 0), 'currency', 'EUR')) AS apc_prices"), "sources", Field("apc_prices", "apc_prices", "source_apc_prices")),
     "SELECT s_suppkey AS source_id, CAST(s_suppkey % 7 AS DOUBLE) AS price, 'EUR' AS currency FROM supplier WHERE s_suppkey % 7 != 0")
_add("societies", _pattern(_suppliers("array(named_struct('organization', CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END, 'url', s_name)) AS societies"), "sources", Field("societies", "societies", "source_societies")),
     "SELECT s_suppkey AS source_id, s_name AS organization, s_name AS url FROM supplier WHERE s_suppkey % 3 != 0")
_add("mesh", _pattern(_suppliers("array(named_struct('descriptor_ui', concat('D', s_nationkey), 'descriptor_name', s_name, 'is_major_topic', s_suppkey % 2 = 0), named_struct('descriptor_ui', CAST(NULL AS string), 'descriptor_name', s_name, 'is_major_topic', true)) AS mesh"), "works", Field("mesh", "mesh", "work_mesh")),
     "SELECT s_suppkey AS work_id, 'D' || s_nationkey AS descriptor_ui, s_name AS descriptor_name, CAST(NULL AS VARCHAR) AS qualifier_ui, CAST(NULL AS VARCHAR) AS qualifier_name, s_suppkey % 2 = 0 AS is_major_topic FROM supplier")
_add("awards", _pattern(_suppliers("array(named_struct('id', concat('G', s_suppkey), 'display_name', s_name, 'funder_award_id', 'x', 'funder_id', concat('https://graph.example/F', s_nationkey), 'funder_display_name', s_name)) AS awards"), "works", Field("awards", "awards", "work_awards")),
     "SELECT s_suppkey AS work_id, s_suppkey AS award_id, s_name AS display_name, 'x' AS funder_award_id, CAST(s_nationkey AS BIGINT) AS funder_id, s_name AS funder_display_name FROM supplier")
_PEOPLE = "array(named_struct('given_name', s_name, 'family_name', 'f', 'orcid', CAST(NULL AS string), 'affiliation', named_struct('name', s_name, 'country', 'ZZ', 'ids', array(named_struct('id', s_name, 'type', 'ror', 'asserted_by', 'me'))))) AS investigators"
_NESTED = (Field("affiliation", "investigators", "award_investigator_affiliations"),)
_add("investigators", _pattern(_suppliers(_PEOPLE), "awards", Field("investigators", "investigators", "award_investigators", nested=_NESTED)),
     "SELECT s_suppkey AS award_id, s_name AS given_name, 'f' AS family_name, CAST(NULL AS VARCHAR) AS orcid, s_name AS affiliation_name, 'ZZ' AS affiliation_country, CAST(NULL AS VARCHAR) AS role_start, false AS is_lead, false AS is_co_lead FROM supplier")
_add("investigator_affiliations", _pattern(_suppliers(_PEOPLE), "awards", Field("investigators", "investigators", "award_investigators", nested=_NESTED), "award_investigator_affiliations"),
     "SELECT s_suppkey AS award_id, CAST(NULL AS VARCHAR) AS investigator_orcid, 'f' AS investigator_family_name, s_name AS affiliation_id, 'ror' AS affiliation_type, 'me' AS asserted_by FROM supplier")
_add("generic_list", _pattern(_suppliers("array(named_struct('a', s_name, 'b', named_struct('c', s_nationkey))) AS things"), "sources", Field("things", "generic_list", "source_things", columns=(("a", "a", "str"), ("b_c", "b.c", "int")))),
     "SELECT s_suppkey AS source_id, s_name AS a, CAST(s_nationkey AS VARCHAR) AS b_c FROM supplier")
_add("json_blob", _pattern(_suppliers("named_struct('a', s_name) AS extra"), "sources", Field("extra", "json_blob", "source_extras", single=True)),
     "SELECT s_suppkey AS source_id, '{\"a\":\"' || s_name || '\"}' AS extra FROM supplier")


def _ordered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a list of items, each with its part and a list of its suppliers."""
    named = lambda letter, c: F.struct(F.concat(F.lit(letter), F.col(c)).alias("id"))
    item = F.struct(named("P", "l_partkey").alias("part"), F.col("l_linenumber").alias("line"), F.array(named("S", "l_suppkey"), named("S", "l_linenumber")).alias("suppliers"))
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("parts"))
    return items.select(F.concat(F.lit("https://graph.example/O"), "l_orderkey").alias("id"), "parts")


_ORDER_PARTS = Field("parts", "nested_id_ref", "order_parts", id_path="part.id", extras=("line",), nested=(Field("suppliers", "id_ref", "order_parts_suppliers"),))
_add("nested_id_ref", _pattern(_ordered_items, "orders", _ORDER_PARTS, "order_parts_suppliers"),
     "SELECT l_orderkey AS order_id, CAST(l_partkey AS VARCHAR) AS part_id, unnest([l_suppkey, CAST(l_linenumber AS BIGINT)]) AS supplier_id FROM lineitem")
_add("id_ref", _pattern(_ordered_items, "orders", _ORDER_PARTS), "SELECT l_orderkey AS order_id, CAST(l_partkey AS VARCHAR) AS part_id, l_linenumber AS line FROM lineitem")
_add("scalar_flatten", _pattern(lambda spark, sf_dir: table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.from_json("props", "k bigint").alias("props")), "events", Field("props", "scalar", "event_main", columns=(("props_k", "props.k", "int"),)), "event_main"),
     "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
_add("external_ids", _pattern(lambda spark, sf_dir: table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.from_json("props", "k bigint").alias("ids")), "events", Field("ids", "external_ids", "event_external_ids", single=True)),
     "SELECT event_id, 'k' AS source, CAST(json_extract(props, '$.k') AS VARCHAR) AS value FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) != 0")


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents with their places, from records that hold the index as an object."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "[ \t\r\n]+")).alias("p", "w")).where("w != ''")
    index = words.groupBy("doc_id", "w").agg(F.sort_array(F.collect_list("p")).alias("ps")).groupBy(F.col("doc_id").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("abstract_inverted_index"))
    field = Field("abstract_inverted_index", "inverted_index", "document_abstracts", single=True)
    df = raw_tables(jsonl.read_table(index), Schema("documents", (field,)))["document_abstracts"]
    return df.select("document_id", "word", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


_add("inverted_index", inverted_index, """
SELECT doc_id AS document_id, w AS word, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS positions
FROM (SELECT doc_id, unnest(t) AS w, unnest(range(len(t))) AS p FROM (SELECT doc_id, string_split_regex(text, '[ \\t\\r\\n]+') AS t FROM documents WHERE text IS NOT NULL))
WHERE w != '' GROUP BY ALL""")  # fmt: skip


def time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and year, as a list of years in each customer's record."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"), F.sum("o_totalprice").cast("double").alias("total"))
    lists = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list(F.struct("year", F.col("n").alias("orders"), F.when(F.col("n") > 1, F.floor("total") + 0.5).alias("whole"))).alias("counts_by_year"))
    field = Field("counts_by_year", "time_series", "customer_counts_by_year", extras=("orders", "whole"))
    return raw_tables(jsonl.read_table(lists), Schema("customers", (field,)))["customer_counts_by_year"].drop("source_key")


_add("time_series", time_series, """
SELECT o_custkey AS customer_id, year, orders, CASE WHEN orders > 1 THEN CAST(floor(total) AS BIGINT) ELSE 0 END AS whole
FROM (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS orders, sum(o_totalprice) AS total FROM orders GROUP BY ALL)""")


# ---- ids, types, texts ------------------------------------------------------------------------


def extract_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    works = table(spark, sf_dir, "works")
    return works.select("id", ids.trailing_number(F.col("id")).alias("number"), ids.last_segment(F.col("id")).alias("segment"), ids.short_id(F.col("id")).alias("short"))


_add("extract_id", extract_id, f"""
SELECT id, {_number('id')} AS number, nullif(regexp_extract(id, '([^/]*)$', 1), '') AS segment,
  upper(regexp_extract(id, '(?:^|[^A-Za-z0-9])([A-Za-z])([0-9]+)', 1)) || CAST(regexp_extract(id, '(?:^|[^A-Za-z0-9])([A-Za-z])([0-9]+)', 2) AS BIGINT) AS short FROM works""")  # fmt: skip


_MIXTURES = {
    "ints": "cast(p_size AS string)", "int_float": "CASE WHEN p_size % 2 = 0 THEN cast(p_size AS string) ELSE '0.5' END",
    "bool_int": "CASE WHEN p_size % 2 = 0 THEN 'true' ELSE cast(p_size AS string) END", "any_text": "CASE WHEN p_size = 1 THEN '\"x\"' ELSE 'true' END", "bools": "'false'",
}


def type_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that schema inference gives to columns of integers, doubles, booleans and text, in several mixtures."""
    cells = [c for name, cell in _MIXTURES.items() for c in (F.lit(f', "{name}": '), F.expr(cell))]
    lines = table(spark, sf_dir, "part").select(F.lit("f").alias("source_key"), F.concat(F.lit('{"id": "P'), "p_partkey", F.lit('"'), *cells, F.lit("}")).alias("line"))
    found = probe(lines.withColumn("record", jsonl.parse(F.col("line"))), "parts").tables["part_main"]
    return spark.createDataFrame([(c, t) for c, t in found if c in _MIXTURES], "mixture string, column_type string")


_add("type_widening", type_widening, """
WITH cells AS (SELECT unnest([{'m': 'ints', 'c': CAST(p_size AS VARCHAR)}, {'m': 'int_float', 'c': CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '0.5' END},
  {'m': 'bool_int', 'c': CASE WHEN p_size % 2 = 0 THEN 'true' ELSE CAST(p_size AS VARCHAR) END}, {'m': 'any_text', 'c': CASE WHEN p_size = 1 THEN '"x"' ELSE 'true' END}, {'m': 'bools', 'c': 'false'}]) AS x FROM part),
t AS (SELECT x.m AS mixture, list(DISTINCT json_type(CAST(x.c AS JSON))) AS seen FROM cells GROUP BY 1)
SELECT mixture, CASE WHEN list_contains(seen, 'VARCHAR') THEN 'str' WHEN list_contains(seen, 'DOUBLE') THEN 'float' WHEN list_has_any(seen, ['UBIGINT', 'BIGINT']) THEN 'int' ELSE 'bool' END AS column_type FROM t""")  # fmt: skip


def size_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select("p_partkey", (F.pow(F.lit(2.0), F.col("p_size")) * 3).cast("bigint").alias("n"))
    return sizes.select("p_partkey", naming.readable_size(F.col("n")).alias("size_text"))


_add("size_texts", size_texts, """
WITH s AS (SELECT p_partkey, CAST(CAST(pow(2.0, p_size) * 3 AS BIGINT) AS DOUBLE) AS n FROM part)
SELECT p_partkey, CASE WHEN n < 1024 THEN printf('%.1f B', n) WHEN n < pow(1024, 2) THEN printf('%.1f KB', n / 1024) WHEN n < pow(1024, 3) THEN printf('%.1f MB', n / pow(1024, 2))
  WHEN n < pow(1024, 4) THEN printf('%.1f GB', n / pow(1024, 3)) WHEN n < pow(1024, 5) THEN printf('%.1f TB', n / pow(1024, 4)) ELSE printf('%.1f PB', n / pow(1024, 5)) END AS size_text FROM s""")  # fmt: skip


def source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "raw_records").select("source_file").distinct()
    return files.select("source_file", naming.source_key_column(F.col("source_file")).alias("source_key"), naming.local_name(F.regexp_replace("source_file", r"\.jsonl\.gz$", ".gz")).alias("local_name"))


_add("source_keys", source_keys, "SELECT DISTINCT source_file, replace(regexp_replace(source_file, '(\\.jsonl\\.gz|\\.jsonl|\\.gz)$', ''), '/', '__') AS source_key, source_file AS local_name FROM raw_records")


def line_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, blank and malformed lines of each source file."""
    lines = table(spark, sf_dir, "raw_records").select(F.col("source_file").alias("source_key"), F.col("line_text").alias("line"))
    return jsonl.losses(lines.withColumn("record", jsonl.parse(F.col("line"))))


_add("line_losses", line_losses, """
SELECT source_file AS source_key, count(*) FILTER (WHERE ok) AS records, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT ok AND NOT blank) AS malformed
FROM (SELECT source_file, line_text IS NULL OR trim(line_text) = '' AS blank, line_text IS NOT NULL AND json_valid(line_text) AND trim(line_text) LIKE '{%' AS ok FROM raw_records) GROUP BY 1""")


# ---- graphs -----------------------------------------------------------------------------------


def _orders_parts(spark: SparkSession, sf_dir: str, namespaced: bool = False) -> DataFrame:
    return graph.ends(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", ("O", "P") if namespaced else ("", ""))


def csr_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.build(_orders_parts(spark, sf_dir))["edges"]


def csr_indptr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.build(_orders_parts(spark, sf_dir))["rows"]


def csr_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.neighbours(graph.build(_orders_parts(spark, sf_dir))["edges"])


def csr_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.statistics(graph.build(_orders_parts(spark, sf_dir)))


def graph_nodes_namespaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.build(_orders_parts(spark, sf_dir, True))["ids"]


def combined_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = graph.ends(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", ("O", "C"))
    return graph.edges_of(union_all([_orders_parts(spark, sf_dir, True), orders]))


def citation_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row pointers of the graph of works, their references and their authors."""
    records = _records(spark, sf_dir, "works")
    names = ["work_referenced_works", "work_authorships"]
    return graph.build(graph.combined(tables(records, probe(records, "works", wanted=names), names)))["rows"]


def lineage_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the registered graphs of publishers and institutions, each entity's ids apart."""
    frames = {}
    for entity, name in (("publishers", "publisher_lineage"), ("institutions", "institution_lineage"), ("institutions", "institution_associated_institutions"), ("authors", "author_affiliations")):
        records = _records(spark, sf_dir, entity)
        frames |= tables(records, probe(records, entity, wanted=[name]), [name])
    return graph.edges_of(graph.combined(frames))


_CSR = """
WITH e AS (SELECT DISTINCT l_orderkey AS s, l_partkey AS t FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL),
ids AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS idx FROM (SELECT s AS id FROM e UNION SELECT t FROM e)),
d AS (SELECT a.idx AS src_idx, b.idx AS tgt_idx FROM e JOIN ids a ON a.id = e.s JOIN ids b ON b.id = e.t)
"""
_add("csr_edges", csr_edges, _CSR + "SELECT src_idx, tgt_idx, CAST(1 AS FLOAT) AS weight FROM d")
_add("csr_indptr", csr_indptr, _CSR + "SELECT idx, degree, CAST(sum(degree) OVER (ORDER BY idx) AS BIGINT) AS row_end FROM (SELECT ids.idx, count(d.src_idx) AS degree FROM ids LEFT JOIN d ON d.src_idx = ids.idx GROUP BY 1)")
_add("csr_indices", csr_indices, _CSR + "SELECT src_idx, CAST(row_number() OVER (PARTITION BY src_idx ORDER BY tgt_idx) - 1 AS INTEGER) AS position, tgt_idx FROM d")
_add("csr_stats", csr_stats, _CSR + "SELECT (SELECT count(*) FROM ids) AS n_nodes, (SELECT count(*) FROM d) AS n_edges")
_add("graph_nodes_namespaced", graph_nodes_namespaced, "SELECT space, id, row_number() OVER (ORDER BY space, id) - 1 AS idx FROM (SELECT 'O' AS space, l_orderkey AS id FROM lineitem UNION SELECT 'P', l_partkey FROM lineitem)")
_add("combined_graph", combined_graph, "SELECT 'O' AS src_space, l_orderkey AS src, 'P' AS tgt_space, l_partkey AS tgt FROM lineitem UNION SELECT 'O', o_orderkey, 'C', o_custkey FROM orders")
_add("citation_graph", citation_graph, f"""
WITH w AS (SELECT try_cast({_own('id')} AS BIGINT) AS k, referenced_works, authorships FROM works),
l AS (SELECT 'W' AS ss, k AS s, 'W' AS ts, {_number('x')} AS t, true AS ok FROM (SELECT k, unnest(referenced_works) AS x FROM w) WHERE {_number('x')} IS NOT NULL
  UNION ALL SELECT 'W', k, 'A', try_cast({_own('x.author.id')} AS BIGINT), true FROM (SELECT k, unnest(authorships) AS x FROM w) WHERE {_own('x.author.id')} IS NOT NULL),
e AS (SELECT DISTINCT ss, s, ts, t FROM l WHERE s IS NOT NULL AND t IS NOT NULL),
ids AS (SELECT sp, id, row_number() OVER (ORDER BY sp, id) - 1 AS idx FROM (SELECT ss AS sp, s AS id FROM l WHERE s IS NOT NULL UNION SELECT ts, t FROM l WHERE t IS NOT NULL)),
c AS (SELECT ids.idx, count(e.s) AS degree FROM ids LEFT JOIN e ON e.ss = ids.sp AND e.s = ids.id GROUP BY 1)
SELECT idx, degree, CAST(sum(degree) OVER (ORDER BY idx) AS BIGINT) AS row_end FROM c""")  # fmt: skip


_add("lineage_graph", lineage_graph, f"""
SELECT DISTINCT * FROM (SELECT 'P' AS src_space, try_cast({_own('id')} AS BIGINT) AS src, 'P' AS tgt_space, {_number('x')} AS tgt FROM (SELECT id, unnest(lineage) AS x FROM publishers)
  UNION ALL SELECT 'I', try_cast({_own('id')} AS BIGINT), 'I', {_number('x')} FROM (SELECT id, unnest(lineage) AS x FROM institutions)
  UNION ALL SELECT 'I', try_cast({_own('id')} AS BIGINT), 'I', try_cast({_own('x.id')} AS BIGINT) FROM (SELECT id, unnest(associated_institutions) AS x FROM institutions)
  UNION ALL SELECT 'A', try_cast({_own('id')} AS BIGINT), 'I', try_cast({_own('x.institution.id')} AS BIGINT) FROM (SELECT id, unnest(affiliations) AS x FROM authors))
WHERE src IS NOT NULL AND tgt IS NOT NULL""")  # fmt: skip


# ---- what is to be done again -----------------------------------------------------------------


def manifest_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    before = parts.where("p_size > 5")
    now = parts.where("p_size <= 45").withColumn("p_size", F.when(F.col("p_brand").endswith("1"), F.col("p_size") + 1).otherwise(F.col("p_size")))
    return incremental.drift(before, now, "p_partkey", "p_size")


_DRIFT = """
WITH b AS (SELECT p_partkey AS k, p_size AS s FROM part WHERE p_size > 5),
n AS (SELECT p_partkey AS k, CASE WHEN p_brand LIKE '%1' THEN p_size + 1 ELSE p_size END AS s FROM part WHERE p_size <= 45),
d AS (SELECT coalesce(b.k, n.k) AS p_partkey, CASE WHEN b.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN b.s IS DISTINCT FROM n.s THEN 'changed' END AS change FROM b FULL JOIN n ON b.k = n.k)
"""
_add("manifest_drift", manifest_drift, _DRIFT + "SELECT * FROM d WHERE change IS NOT NULL")
_add("drift_counts", lambda spark, sf_dir: incremental.drift_counts(manifest_drift(spark, sf_dir)), _DRIFT + "SELECT count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'removed') AS removed, count(*) FILTER (WHERE change = 'changed') AS changed FROM d")


def _keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_key"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_key"), F.col("l_linenumber").alias("table_name"))
    return orders, lines


_add("pending_anti", lambda spark, sf_dir: incremental.pending(*_keys(spark, sf_dir)), "SELECT DISTINCT o_orderkey AS source_key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
_add("completed_semi", lambda spark, sf_dir: incremental.completed(_keys(spark, sf_dir)[0], _keys(spark, sf_dir)[1]), "SELECT DISTINCT l_orderkey AS source_key FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)")
_add("incomplete_shards", lambda spark, sf_dir: incremental.incomplete(_keys(spark, sf_dir)[1], "source_key", "table_name"),
     "WITH c AS (SELECT l_orderkey AS source_key, count(DISTINCT l_linenumber) AS n_tables FROM lineitem GROUP BY 1) SELECT * FROM c WHERE n_tables < (SELECT max(n_tables) FROM c)")
_add("shard_status", lambda spark, sf_dir: incremental.shard_status(*_keys(spark, sf_dir)), """
WITH c AS (SELECT l_orderkey AS k, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1), o AS (SELECT DISTINCT o_orderkey AS k FROM orders)
SELECT coalesce(o.k, c.k) AS source_key, CASE WHEN o.k IS NULL THEN 'orphan' WHEN c.k IS NULL THEN 'missing' WHEN c.n < (SELECT max(n) FROM c) THEN 'incomplete' ELSE 'complete' END AS status FROM o FULL JOIN c ON o.k = c.k""")  # fmt: skip
_add("slice_mod", lambda spark, sf_dir: incremental.in_slice(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 3, 1),
     "SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i % 3 = 1")


def obsolete_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "raw_records").select(F.col("source_file").alias("path")).distinct()
    return incremental.obsolete(files.select(F.regexp_replace("path", r"\.jsonl\.gz$", ".gz").alias("path")), files.where("path NOT LIKE '%part_00000%'"))


_add("obsolete_files", obsolete_files, "SELECT DISTINCT source_file AS path FROM raw_records WHERE source_file LIKE '%part_00000%'")
_add("fingerprint", lambda spark, sf_dir: graph.fingerprint(table(spark, sf_dir, "raw_records").select(F.col("source_file").alias("name")).distinct()),
     "SELECT substr(sha256(string_agg(f, chr(10) ORDER BY f)), 1, 16) AS fingerprint FROM (SELECT DISTINCT source_file AS f FROM raw_records)")


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "raw_records").select(naming.source_key_column(F.col("source_file")).alias("k"), "entity")
    return files.select(F.concat(F.lit("data/"), "entity", F.lit("/topics/source_key="), "k", F.lit("/part-0.parquet")).alias("path"))


_add("completed_paths", lambda spark, sf_dir: incremental.completed_paths(_shards(spark, sf_dir)), """
SELECT DISTINCT entity || '/topics' AS table_name, replace(regexp_replace(source_file, '(\\.jsonl\\.gz|\\.jsonl|\\.gz)$', ''), '/', '__') AS source_key FROM raw_records""")


def stale_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "raw_records").select(F.col("source_file").alias("path")).distinct()
    return incremental.stale(files, files.where("path LIKE 'works%'").select(F.regexp_replace("path", r"\.jsonl\.gz$", ".gz").alias("path")))


_add("stale_files", stale_files, "SELECT DISTINCT source_file AS path FROM raw_records WHERE source_file NOT LIKE 'works%'")


def row_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all source files of an entity, estimated from five of its files that are evenly spread; what comes to the driver is the listing."""
    lines = table(spark, sf_dir, "raw_records").select("entity", "source_file")
    listed: dict[str, list[str]] = {}
    for entity, file in sorted(lines.distinct().collect()):
        listed.setdefault(entity, []).append(file)
    sampled = {e: catalog.spread(names, 5) for e, names in listed.items()}
    counts = dict(lines.where(F.col("source_file").isin(*{f for names in sampled.values() for f in names})).groupBy("source_file").agg(F.count("*")).collect())
    rows = [(e, catalog.estimated_rows([counts[f] for f in names], len(listed[e])), len(names), len(listed[e])) for e, names in sampled.items()]
    return spark.createDataFrame(rows, "entity string, n_rows long, n_sampled int, n_files int")


_add("row_estimate", row_estimate, """
WITH c AS (SELECT entity, source_file, count(*) AS n FROM raw_records GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY source_file) - 1 AS k, count(*) OVER (PARTITION BY entity) AS m FROM c),
s AS (SELECT * FROM p WHERE m <= 5 OR k IN (SELECT i * (p.m - 1) // 4 FROM range(5) t(i)))
SELECT entity, CAST(floor(sum(n) / count(*) * any_value(m)) AS BIGINT) AS n_rows, CAST(count(*) AS INTEGER) AS n_sampled, CAST(any_value(m) AS INTEGER) AS n_files FROM s GROUP BY 1""")


def bin_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source files spread over four jobs by their number of lines; the listing of files is what comes to the driver."""
    files = table(spark, sf_dir, "raw_records").groupBy("source_file").count().collect()
    packed = incremental.bin_pack([(r[0], r[1]) for r in files], 4)
    return spark.createDataFrame([(b, f) for b, names in enumerate(packed) for f in names], "job int, source_file string")


_add("bin_pack", bin_pack, """
WITH RECURSIVE f AS (SELECT source_file, n, row_number() OVER (ORDER BY n DESC, source_file) - 1 AS k FROM (SELECT source_file, count(*) AS n FROM raw_records GROUP BY 1)),
held AS (SELECT -1 AS round, i AS job, 0 AS bytes, CAST(NULL AS VARCHAR) AS source_file FROM range(4) t(i)
  UNION ALL SELECT h.round + 1, h.job, CAST(h.bytes + coalesce(f.n, 0) AS INTEGER), f.source_file
    FROM (SELECT *, row_number() OVER (ORDER BY bytes, job) - 1 AS place FROM held) h LEFT JOIN f ON f.k = (h.round + 1) * 4 + h.place WHERE h.round < (SELECT max(k) // 4 FROM f))
SELECT CAST(job AS INTEGER) AS job, source_file FROM held WHERE source_file IS NOT NULL""")
