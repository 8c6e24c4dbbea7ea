"""Queries of the operators in this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestloom.functions.ids import id_number, short_id, slug
from nestloom.llm import contamination, cooccurrence, names, packing, sentences
from nestloom.runtime import table


def _cooccurring(spark: SparkSession, sf_dir: str, min_count: int, min_lift: float) -> DataFrame:
    works = table(spark, sf_dir, "works")
    fields = {f: F.transform(F.col(f)["id"], lambda x: F.lower(short_id(x))) for f in ("topics", "concepts")}
    fields["keywords"] = F.transform(F.col("keywords")["id"], slug)
    return cooccurrence.cooccurring(works, id_number(F.col("id"), "w"), fields, min_count=min_count, min_lift=min_lift)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of topics, concepts and keywords in five works or more, three times as often as by chance."""
    return _cooccurring(spark, sf_dir, 5, 3).select("field_name", "item_a", "item_b")


def p2_surprise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs that share a work with their expected count, tail and q-value."""
    return _cooccurring(spark, sf_dir, 1, 0)


def _names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    authors, works = table(spark, sf_dir, "authors"), table(spark, sf_dir, "works")
    people = authors.select(id_number(F.col("id"), "a").alias("id"), F.col("display_name").alias("name"), F.explode(F.col("last_known_institutions")["id"]).alias("i"))
    people = people.select("id", "name", id_number(F.col("i"), "i").alias("g"))
    held = works.select(id_number(F.col("id"), "w").alias("k1"), F.posexplode("authorships").alias("k2", "a"))
    held = held.where(id_number(F.col("a.author.id")).isNull())
    name = F.coalesce(F.nullif(F.trim("a.raw_author_name"), F.lit("")), F.col("a.author.display_name"))
    mentions = held.select("k1", "k2", name.alias("name"), F.explode(F.col("a.institutions")["id"]).alias("i")).select("k1", "k2", "name", id_number(F.col("i"), "i").alias("g"))
    return people, mentions


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The author rows of one person, and the author behind each authorship that lacks an author id."""
    persons, attached = names.link_names(*_names(spark, sf_dir))
    short = lambda c: F.concat(F.lit("A"), F.col(c).cast("string"))
    pairs = persons.select(F.lit("author").alias("match_kind"), short("id_a").alias("key_a"), short("id_b").alias("key_b"))
    place = F.concat(F.lit("W"), F.col("k1").cast("string"), F.lit(":"), F.col("k2").cast("string"))
    return pairs.unionByName(attached.select(F.lit("authorship").alias("match_kind"), place.alias("key_a"), short("id").alias("key_b")))


def p5_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every author id of a person who has several, with the smallest of them."""
    return names.linked(*_names(spark, sf_dir))[0].select(F.col("node").alias("author_id"), F.col("root").alias("person_id"))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a container of 2,048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the containers' room is used."""
    return packing.packing_report(packing.packed(table(spark, sf_dir, "documents")))


def p8_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and how many of them or of their containers break a rule of packing."""
    docs = table(spark, sf_dir, "documents")
    return packing.packing_faults(docs, packing.packed(docs))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that give away an evaluation item: half of its words lie in shared passages."""
    found = contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), least_share=0.5)
    return found.select("doc_id", "item_id")


def p9_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All overlaps of documents and evaluation items, exact and substitution-tolerant."""
    return contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document with its place."""
    return sentences.sentences(table(spark, sf_dir, "documents"))


def _num(col: str, letters: str) -> str:
    return f"try_cast(regexp_extract({col}, '(?:^|[^A-Za-z0-9])[{letters}]([0-9]+)', 1) AS BIGINT)"


QUERIES = {"p2_found": p2_found, "p2_surprise": p2_surprise, "p5_found": p5_found, "p5_members": p5_members, "p8_packed": p8_packed, "p8_report": p8_report, "p8_faults": p8_faults, "p9_found": p9_found, "p9_overlaps": p9_overlaps, "p10_found": p10_found}

ORACLE = {
    "p8_faults": "SELECT count(*) AS n_documents, 0 AS n_misplaced, 0 AS n_split, 0 AS n_overfull FROM documents",
    "p2_found": f"""
WITH w AS (SELECT {_num("id", "wW")} AS k, topics, concepts, keywords FROM works WHERE {_num("id", "wW")} IS NOT NULL),
items AS (SELECT DISTINCT f, k, i FROM (
  SELECT 'topics' AS f, k, 't' || {_num("x.id", "tT")} AS i FROM (SELECT k, unnest(topics) AS x FROM w)
  UNION ALL SELECT 'concepts', k, 'c' || {_num("x.id", "cC")} FROM (SELECT k, unnest(concepts) AS x FROM w)
  UNION ALL SELECT 'keywords', k, nullif(lower(regexp_extract(regexp_replace(regexp_replace(trim(x.id), '[?#].*$', ''), '[/ ]+$', ''), '([^/]*)$', 1)), '') FROM (SELECT k, unnest(keywords) AS x FROM w)) WHERE i IS NOT NULL),
n AS (SELECT f, i, count(*) AS n FROM items GROUP BY ALL),
total AS (SELECT count(DISTINCT k) AS n FROM w),
pairs AS (SELECT a.f, a.i AS a, b.i AS b, count(*) AS n FROM items a JOIN items b ON a.f = b.f AND a.k = b.k AND a.i < b.i GROUP BY ALL HAVING count(*) >= 5)
SELECT p.f AS field_name, p.a AS item_a, p.b AS item_b FROM pairs p JOIN n x ON x.f = p.f AND x.i = p.a JOIN n y ON y.f = p.f AND y.i = p.b, total
WHERE p.n * total.n >= 3 * x.n * y.n""",
}
