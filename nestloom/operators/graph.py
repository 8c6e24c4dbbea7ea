"""Graphs in compressed sparse rows: edges, dense node numbers and row pointers as tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nestloom.functions.naming import table_path
from nestloom.runtime import looked_up, materialize, union_all
from nestloom.sources import files

# fixed values: relationship tables that are graphs, with the letters and columns of their two
# ends; a letter of "" stands in the column role_prefix of each row
EDGE_TABLES = {
    "work_referenced_works": (("W", "work_id"), ("W", "referenced_work_id")),
    "work_related_works": (("W", "work_id"), ("W", "related_work_id")),
    "work_related": (("W", "work_id"), ("W", "related_work_id")),
    "work_authorships": (("W", "work_id"), ("A", "authorship_id")),
    "work_topics": (("W", "work_id"), ("T", "topic_id")),
    "work_concepts": (("W", "work_id"), ("C", "concept_id")),
    "work_funders": (("W", "work_id"), ("F", "funder_id")),
    "work_locations": (("W", "work_id"), ("S", "source_id")),
    "author_affiliations": (("A", "author_id"), ("I", "affiliation_id")),
    "institution_associated_institutions": (("I", "institution_id"), ("I", "associated_institution_id")),
    "institution_lineage": (("I", "institution_id"), ("I", "lineage_id")),
    "institution_repositories": (("I", "institution_id"), ("S", "repositorie_id")),
    "institution_roles": (("I", "institution_id"), ("", "role_entity_id")),
    "publisher_lineage": (("P", "publisher_id"), ("P", "lineage_id")),
    "publisher_roles": (("P", "publisher_id"), ("", "role_entity_id")),
    "funder_roles": (("F", "funder_id"), ("", "role_entity_id")),
    "concept_ancestors": (("C", "concept_id"), ("C", "ancestor_id")),
}
#: Nodes whose row pointers are summed in one group.
BLOCK = 1 << 16


class NotAGraph(ValueError):
    """The relationship is not registered as a graph."""


def ends(df: DataFrame, source: str, target: str, spaces: tuple[str, str | Column] = ("", "")) -> DataFrame:
    """``src_space, src, tgt_space, tgt`` of a table's two id columns; a space keeps ids of different entities apart."""
    space = spaces[1] if isinstance(spaces[1], Column) else F.lit(spaces[1])
    return df.select(F.lit(spaces[0]).alias("src_space"), F.col(source).try_cast("bigint").alias("src"), space.alias("tgt_space"), F.col(target).try_cast("bigint").alias("tgt"))


def edges_of(links: DataFrame) -> DataFrame:
    """The distinct edges with both ends."""
    return links.where("src IS NOT NULL AND tgt IS NOT NULL").distinct()


def nodes_of(links: DataFrame) -> DataFrame:
    """The distinct ends ``space, id``, also of links whose other end is null."""
    either = links.select(F.col("src_space").alias("space"), F.col("src").alias("id")).unionByName(links.select(F.col("tgt_space").alias("space"), F.col("tgt").alias("id")))
    return either.where("id IS NOT NULL").distinct()


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds ``idx``, the place in the sort order from 0, without bringing all rows to one task.

    Ranges are sorted apart; what comes together is one count a range.
    """
    spark = nodes.sparkSession
    ranged = nodes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    placed = materialize(ranged.select("*", F.shiftright("_m", 33).alias("_part"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_local")).drop("_m"), "ranges")
    starts, before = [], 0
    for part, n in sorted(placed.groupBy("_part").agg(F.count("*")).collect()):
        starts.append((part, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(starts, "_part long, _start long"))
    return placed.join(starts, "_part").withColumn("idx", F.col("_start") + F.col("_local")).drop("_part", "_local", "_start")


def remapped(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """``src_idx, tgt_idx`` of edges, by the numbers in ``ids`` (space, id, idx); ends that many edges share are split."""
    source = ids.select(F.col("space").alias("src_space"), F.col("id").alias("src"), F.col("idx").alias("src_idx"))
    target = ids.select(F.col("space").alias("tgt_space"), F.col("id").alias("tgt"), F.col("idx").alias("tgt_idx"))
    by_source = looked_up(edges, source, ["src_space", "src"]).select("src_idx", "tgt_space", "tgt")
    return looked_up(by_source, target, ["tgt_space", "tgt"]).select("src_idx", "tgt_idx")


def row_pointers(edges: DataFrame, ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """``idx, degree, row_end``: for each node its edges and where its row ends in the sorted edges.

    Degrees are summed in blocks of consecutive nodes, and the blocks' sums once more.
    """
    degrees = edges.groupBy(F.col("src_idx").alias("idx")).agg(F.count("*").alias("degree"))
    rows = ids.select("idx").join(degrees, "idx", "left").select("idx", F.coalesce("degree", F.lit(0)).alias("degree"), F.floor(F.col("idx") / block).alias("_block"))
    rows = materialize(rows, "degrees")
    sums = rows.groupBy("_block").agg(F.sum("degree").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("_block", before.alias("_start"))
    inside = F.sum("degree").over(Window.partitionBy("_block").orderBy("idx"))
    return rows.join(starts, "_block").select("idx", "degree", (F.col("_start") + inside).alias("row_end"))


def neighbours(edges: DataFrame) -> DataFrame:
    """``src_idx, position, tgt_idx``: the indices of each row in order; the edges of one node may lie in many ranges."""
    sorted_edges = materialize(numbered(edges.select("src_idx", "tgt_idx"), "src_idx", "tgt_idx"), "sorted-edges")
    starts = sorted_edges.groupBy("src_idx").agg(F.min("idx").alias("_start"))
    return looked_up(sorted_edges, starts, ["src_idx"]).select("src_idx", (F.col("idx") - F.col("_start")).cast("int").alias("position"), "tgt_idx")


class Graph(Mapping):
    """``ids`` (space, id, idx), ``edges`` (src_idx, tgt_idx, weight 1.0), ``rows`` (idx, degree, row_end) of links.

    Each is made when it is first asked for.  Without edges all three are empty, even if there
    are ids.
    """

    def __init__(self, links: DataFrame) -> None:
        self._links = links

    def __getitem__(self, name: str) -> DataFrame:
        if name not in tuple(self):
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self) -> Iterator[str]:
        return iter(("ids", "edges", "rows"))

    def __len__(self) -> int:
        return 3

    @cached_property
    def distinct_edges(self) -> DataFrame:
        return materialize(edges_of(self._links), "graph-edges")

    @cached_property
    def is_empty(self) -> bool:
        return not self.distinct_edges.head(1)

    @cached_property
    def ids(self) -> DataFrame:
        if self.is_empty:
            return self._links.select(F.col("src_space").alias("space"), F.col("src").alias("id"), F.col("src").alias("idx")).limit(0)
        # the edges, and the links that lack an end
        half = self._links.where("src IS NULL OR tgt IS NULL")
        return numbered(nodes_of(self.distinct_edges.unionByName(half)), "space", "id")

    @cached_property
    def dense(self) -> DataFrame:
        if self.is_empty:
            return self.distinct_edges.selectExpr("src AS src_idx", "tgt AS tgt_idx").limit(0)
        return remapped(self.distinct_edges, self.ids)

    @cached_property
    def edges(self) -> DataFrame:
        return self.dense.withColumn("weight", F.lit(1.0).cast("float"))

    @cached_property
    def rows(self) -> DataFrame:
        return self.ids.selectExpr("idx", "idx AS degree", "idx AS row_end") if self.is_empty else row_pointers(self.dense, self.ids)


def build(links: DataFrame) -> Graph:
    return Graph(links)


def registered(relation: str, df: DataFrame, namespaced: bool = True) -> DataFrame:
    """The links of a registered relationship's table."""
    if relation not in EDGE_TABLES:
        raise NotAGraph(relation)
    (s, source), (t, target) = EDGE_TABLES[relation]
    return ends(df, source, target, (s, t or F.col("role_prefix")) if namespaced else ("", ""))


def combined(tables: Mapping[str, DataFrame], namespaced: bool = True) -> DataFrame:
    """The links of several registered relationships; none of the frames may be of an unknown one.

    Namespaced, ids of different entities are different nodes; else equal numbers are one node.
    """
    unknown = sorted(set(tables) - EDGE_TABLES.keys())
    if unknown:
        raise NotAGraph(", ".join(unknown))
    if not tables:
        raise RuntimeError("no relationship to build a graph of")
    return union_all([registered(name, df, namespaced) for name, df in tables.items()])


def read_relations(spark: SparkSession, root: str, relations: Iterable[str], warn: Callable[[str], None] = print) -> dict[str, DataFrame]:
    """The tables of relationships below ``root/<entity>/<table>``; one that is not there is named to ``warn`` and left out."""
    out = {}
    for name in relations:
        if name not in EDGE_TABLES:
            raise NotAGraph(name)
        folder = f"{root}/{table_path(name)}"
        if files.walk(folder, ".parquet"):
            out[name] = spark.read.parquet(folder)
        else:
            warn(f"{name}: nothing in {folder}")
    return out


def statistics(graph: Mapping[str, DataFrame]) -> DataFrame:
    nodes = graph["ids"].agg(F.count("*").alias("n_nodes"))
    return nodes.crossJoin(graph["edges"].agg(F.count("*").alias("n_edges")))


def export(graph: Mapping[str, DataFrame], folder: str) -> None:
    """Write the tables of a graph; readers of sparse-matrix libraries take indptr, indices and data from them in order."""
    for name, order in (("ids", "idx"), ("rows", "idx")):
        graph[name].repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").parquet(f"{folder}/{name}")
    graph["edges"].repartitionByRange("src_idx", "tgt_idx").sortWithinPartitions("src_idx", "tgt_idx").write.mode("overwrite").parquet(f"{folder}/edges")


def export_npz(graph: Mapping[str, DataFrame], path: str, most: int = 100_000_000) -> None:
    """One file in the layout of sparse-matrix libraries (data, indices, indptr, shape, format), and ``<path>_ids.npy``.

    For graphs of at most ``most`` nodes and edges, which one machine can hold; larger ones raise.
    """
    import numpy as np

    n_nodes, n_edges = statistics(graph).first()
    if n_nodes + n_edges > most:
        raise ValueError(f"{n_nodes} nodes and {n_edges} edges are too many for one file; use export")
    rows = graph["rows"].orderBy("idx").select("row_end").toPandas()["row_end"].to_numpy(np.int64)
    indices = graph["edges"].orderBy("src_idx", "tgt_idx").select("tgt_idx").toPandas()["tgt_idx"].to_numpy(np.int64)
    width = np.int32 if n_edges < 2**31 and n_nodes < 2**31 else np.int64
    indptr = np.concatenate([[0], rows]).astype(width)
    np.savez(path, data=np.ones(len(indices), np.float32), indices=indices.astype(width), indptr=indptr, shape=np.array([n_nodes, n_nodes]), format=np.array(b"csr"))
    np.save(path.removesuffix(".npz") + "_ids.npy", graph["ids"].orderBy("idx").select("id").toPandas()["id"].to_numpy(np.uint64))


def build_all(spark: SparkSession, root: str, out: str, relations: Iterable[str] | None = None, force: bool = False) -> DataFrame:
    """``relation, status, n_nodes, n_edges, n_shards, error`` of the graphs of all (or the given) relationships, each written to ``out/<relation>``.

    A graph whose table has the same files as when it was written is skipped unless forced; one
    without files, or of an unknown relationship, is a row with an error, and the others go on.
    """
    done = []
    for name in EDGE_TABLES if relations is None else relations:
        target = f"{out}/{name}"
        shards = files.walk(f"{root}/{table_path(name)}", ".parquet") if name in EDGE_TABLES else []
        if not shards:
            done.append((name, "failed", None, None, 0, f"unknown relationship {name}" if name not in EDGE_TABLES else f"no files of {name}"))
            continue
        mark = fingerprint(spark.createDataFrame([(f.path[len(root) :],) for f in shards], "name string")).first()[0]
        known = json.loads(files.read_text(f"{target}/_built.json") or "{}")
        status = "skipped"
        if force or known.get("fingerprint") != mark:
            export(build(registered(name, spark.read.parquet(f"{root}/{table_path(name)}"))), target)
            n = {part: spark.read.parquet(f"{target}/{part}").count() for part in ("ids", "edges")}
            known = {"fingerprint": mark, "n_nodes": n["ids"], "n_edges": n["edges"]}
            files.write_text(f"{target}/_built.json", json.dumps(known))
            status = "built"
        done.append((name, status, known["n_nodes"], known["n_edges"], len(shards), None))
    return spark.createDataFrame(done, "relation string, status string, n_nodes long, n_edges long, n_shards long, error string")


def status_counts(results: DataFrame) -> DataFrame:
    """How many graphs were built, skipped and failed."""
    return results.agg(*[F.count_if(F.col("status") == c).alias(c) for c in ("built", "skipped", "failed")])


def fingerprint(names: DataFrame, column: str | Column = "name") -> DataFrame:
    """SHA-256 of a table's file names in order, first 16 digits; a listing, not the data, comes together."""
    return names.agg(F.substring(F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(column))), 256), 1, 16).alias("fingerprint"))
