"""The general training-data operators on small tables with every awkward case."""

import json
import random
from datetime import datetime

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestloom import queries_general as q
from nestloom.functions.ids import id_number, short_id, slug, trailing_number
from nestloom.operators import drift, hierarchy, orphans, snapshots, unnest


def at(text):
    return datetime.fromisoformat(text)


# ---- ids


def test_id_spellings(spark, rows):
    texts = ["https://graph.example/W12", "http://graph.example/w12", " W12", "W12/", "https://graph.example/W12?format=full", "n/a", "", None, "https://graph.example/W"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(id_number(F.col("x"), "w").alias("n"), short_id(F.col("x")).alias("s"))
    assert [tuple(r) for r in df.collect()] == [(12, "W12")] * 5 + [(None, None)] * 4


def test_slug_and_trailing_number(spark):
    df = spark.createDataFrame([("https://g/Keywords/Covid-19/",), ("a-b",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(slug(F.col("x"))).collect()] == ["covid-19", "a-b", None, None]
    assert [r[0] for r in df.select(trailing_number(F.col("x"))).collect()] == [None, None, None, None]


# ---- references


def orphan_rows(spark, works, authors, dead, heavy_share=1000):
    works = spark.createDataFrame(works, "id long, loaded_at timestamp, refs array<long>, who array<long>, target_key string")
    authors = spark.createDataFrame(authors, "id long, loaded_at timestamp")
    dead = spark.createDataFrame(dead, "entity string, key long, deleted_at timestamp")
    facts = [
        orphans.key_facts(k, df, F.col("id"), F.col("loaded_at"), dead.where(F.col("entity") == k).select("key", "deleted_at")) for k, df in (("works", works), ("authors", authors))
    ]
    fields = {"refs": ("works", F.col("refs")), "who": ("authors", F.col("who"))}
    refs = orphans.references(works, F.col("id"), F.col("loaded_at"), fields)
    return orphans.orphan_references(refs, facts[0].unionByName(facts[1]), heavy_share)


WORKS = [
    (1, at("2024-01-05"), [2, 3, 3, None, 9], [7], "clash"),
    (1, at("2024-03-01"), [2], None, None),
    (2, at("2024-02-01"), None, [], None),
    (3, at("2024-01-01"), [1, 2], [8, 7], None),
    (4, None, [9, 1], None, None),
    (None, at("2024-01-01"), [9], [9], None),
]
AUTHORS = [(7, at("2023-01-01")), (7, at("2024-06-01")), (8, at("2023-01-01"))]
DEAD = [("works", 3, at("2024-05-01")), ("authors", 7, at("2024-05-01")), ("authors", 8, at("2024-05-01")), ("works", 3, at("2023-05-01")), ("works", 9, None)]
FOUND = [
    ("refs", "2024-01", 1, 2, "late"), ("refs", "2024-01", 1, 3, "deleted"), ("refs", "2024-01", 1, 9, "deleted"), ("refs", "2024-01", 3, 1, "late"),
    ("refs", "2024-01", 3, 2, "late"), ("refs", None, 4, 9, "deleted"), ("who", "2024-01", 3, 8, "deleted"),
]


@pytest.mark.parametrize("heavy_share", [1000, 3])
def test_orphans(spark, rows, heavy_share):
    found = orphan_rows(spark, WORKS, AUTHORS, DEAD, heavy_share)
    assert rows(found, "field_name", "load_period", "source_key", "target_key", "orphan_kind") == sorted(FOUND, key=str)
    report = orphans.orphan_report(found)
    assert ("refs", "2024-01", "late", 3, 2) in rows(report, "field_name", "load_period", "orphan_kind", "n_references", "n_targets")


def test_orphans_without_rows(spark):
    assert orphan_rows(spark, [], [], []).count() == 0
    assert {r["orphan_kind"] for r in orphan_rows(spark, WORKS[:1], [], []).collect()} == {"missing"}


# ---- snapshots


def changes(spark, data, **options):
    df = spark.createDataFrame(data, "s string, k long, v string, a string, b array<string>")
    return snapshots.snapshot_changes(df, F.col("k"), F.col("s"), F.col("v"), [F.col("a"), F.array_sort("b")], **options)


@pytest.mark.parametrize("per_leaf", [1, 8, 10_000])
def test_snapshot_changes(spark, rows, per_leaf):
    data = [
        ("1", 1, "v1", "x", ["p", "q"]), ("1", 2, "v1", None, None), ("1", 3, "v1", "y", []), ("1", 3, "v1", "y", []), ("1", None, "v1", "y", []), (None, 8, "v", "y", []),
        ("2", 1, "v9", "x", ["q", "p"]), ("2", 2, "v1", "", None), ("2", 4, "v0", "old", None), ("2", 4, "v1", "new", None),
        ("3", 1, "v1", "x", ["p", "q"]), ("3", 2, "v1", "", None), ("3", 4, None, "zzz", None), ("3", 4, "v1", "new", None), ("3", 3, "v1", "y", []),
    ]
    found = rows(changes(spark, data, rows_per_leaf=per_leaf), "snapshot", "key", "change_kind")
    assert found == [("2", 2, "changed"), ("2", 3, "removed"), ("2", 4, "added"), ("3", 3, "added")]


def test_snapshot_empty_and_single(spark):
    assert changes(spark, []).count() == 0
    assert changes(spark, [("1", 1, "v", "a", None)]).count() == 0


def test_snapshot_random(spark, rows):
    rng = random.Random(3)
    states = [{k: rng.choice("abc") for k in range(300) if rng.random() < 0.9} for _ in range(3)]
    data = [(str(i), k, "v", a, None) for i, state in enumerate(states) for k, a in state.items()]
    expected = []
    for i in (1, 2):
        old, new = states[i - 1], states[i]
        expected += [(str(i), k, "added") for k in new.keys() - old] + [(str(i), k, "removed") for k in old.keys() - new] + [(str(i), k, "changed") for k in old.keys() & new if old[k] != new[k]]
    assert rows(changes(spark, data, rows_per_leaf=2), "snapshot", "key", "change_kind") == sorted(expected, key=str)


# ---- hierarchies


def tree_of(spark, nodes, statements):
    nodes = spark.createDataFrame(nodes, "tree string, node long, parent string")
    said = spark.createDataFrame(statements, "tree string, node long, parent long")
    return hierarchy.hierarchy(hierarchy.single_parents(nodes, said))


def test_hierarchy(spark, rows):
    nodes = [("t", n, "clash") for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 2)] + [("u", 1, None), ("t", None, None)]
    said = [("t", 2, 1), ("t", 2, 1), ("t", 3, 2), ("t", 4, 99), ("t", 5, 6), ("t", 6, 7), ("t", 7, 5), ("t", 8, 7), ("t", 9, 9), ("u", 1, None), ("t", None, 1)]
    found = tree_of(spark, nodes, said)
    assert rows(found, "tree", "node", "root", "depth") == sorted(
        [("t", 1, 1, 0), ("t", 2, 1, 1), ("t", 3, 1, 2), ("t", 4, 4, 0), ("t", 5, 5, -1), ("t", 6, 5, -1), ("t", 7, 5, -1), ("t", 8, 5, -1), ("t", 9, 9, -1), ("u", 1, 1, 0)], key=str
    )
    assert found.where("node = 3").first()["path"] == [1, 2, 3]
    assert rows(hierarchy.descendants(found)) == [("t", 1, 2, 1), ("t", 1, 3, 2), ("t", 2, 3, 1)]


def test_long_chain_and_loop(spark):
    chain = [("c", n, None) for n in range(1, 41)]
    said = [("c", n, n - 1) for n in range(2, 31)] + [("c", n, n + 1) for n in range(31, 40)] + [("c", 40, 31)]
    found = {r["node"]: (r["root"], r["depth"]) for r in tree_of(spark, chain, said).collect()}
    assert found[30] == (1, 29)
    assert all(found[n] == (31, -1) for n in range(31, 41))


def test_a_chain_of_two_thousand_levels(spark):
    n = 2_000
    parents = spark.range(n).selectExpr("'c' AS tree", "id AS node", "nullif(id - 1, -1) AS parent")
    found = hierarchy.hierarchy(parents, with_path=False)
    assert found.agg(F.count("*"), F.countDistinct("depth"), F.max("depth"), F.count_if(F.col("root") != 0)).first()[:] == (n, n, n - 1, 0)


def test_hubs_are_split(spark):
    n = 100_000
    # a hub with n children below a chain, and n nodes that hang on one node of a loop
    parents = spark.range(2 * n + 5).selectExpr(
        "'h' AS tree", "id AS node",
        f"CASE WHEN id = 0 THEN NULL WHEN id <= 2 THEN id - 1 WHEN id < {n} + 3 THEN 2 WHEN id = {n} + 3 THEN id + 1 WHEN id = {n} + 4 THEN id - 1 ELSE {n} + 4 END AS parent",
    )
    found = hierarchy.hierarchy(parents, hub_edges=1_000)
    counts = {tuple(r)[:2]: r["count"] for r in found.groupBy("root", "depth").count().collect()}
    assert counts == {(0, 0): 1, (0, 1): 1, (0, 2): 1, (0, 3): n, (n + 3, -1): n + 2}
    assert found.where(f"node = {n}").first()["path"] == [0, 1, 2, n]
    edges = parents.where("parent IS NOT NULL")
    hubs = hierarchy.Hubs(edges, 2 * n + 4, 1_000)
    assert hubs.fans.count() == 2 and min(r["fan"] for r in hubs.fans.collect()) > 400


def test_hierarchy_empty(spark):
    assert tree_of(spark, [], []).count() == 0
    assert [tuple(r)[:4] for r in tree_of(spark, [("t", 1, None)], []).collect()] == [("t", 1, 1, 0)]


# ---- drift


def lines(spark, records):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(records)], "record_id long, entity string, source_file string, line_text string")


def file(n, part="part_0.jsonl.gz"):
    return f"works/updated_date=2024-01-0{n}/{part}"


def drifted(spark, records):
    return drift.match_streams(drift.file_schemas(lines(spark, records), {"works": ["ids", "cby"]}))


def test_drift(spark, rows):
    records = [
        ("works", file(2), json.dumps({"ids": {"doi": 1, "pm": {"x": "a"}}, "cby": [{"y": 1, "n": 2}]})),
        ("works", file(1), json.dumps({"ids": {"doi": "1", "mid": {"x": "a"}}, "cby": [{"y": 1, "n": 2}, {"y": None}]})),
        ("works", file(1), " "), ("works", file(1), None), ("works", file(1), '{"ids": {"zzz'), ("works", file(2), "[1]"), ("works", None, "{}"), ("other", file(1), "{}"),
        ("works", file(3), json.dumps({"ids": {"doi": 1.0, "pm": {"x": "a"}, "new": True}, "cby": []})),
        ("works", file(3), json.dumps({"ids": {"doi": 1.0, "pm": {"x": "a"}, "new": True}, "cby": []})),
        ("works", file(4), "broken"),
    ]
    found = rows(drift.schema_changes(drifted(spark, records)), "source_file", "change_kind", "old_path", "new_path")
    assert found == sorted([
        (file(2), "retyped", "ids.doi", "ids.doi"), (file(2), "renamed", "ids.mid", "ids.pm"),
        (file(3), "retyped", "ids.doi", "ids.doi"), (file(3), "added", "", "ids.new"), (file(3), "removed", "cby", ""), (file(4), "removed", "ids", ""),
    ], key=str)


def test_drift_against_brute_force(spark):
    rng = random.Random(5)
    value = lambda: rng.choice([1, 2.5, "t", None, True, [], ["x"], {"a": rng.choice([1, "b", None])}, [{"c": rng.choice([1, None])}]])
    records = [("works", file(n, f"part_{p}.jsonl.gz"), json.dumps({t: {k: value() for k in rng.sample("abcdefg", 4)} for t in ("ids", "cby")})) for p in range(6) for n in range(1, 6) for _ in range(2)]
    found = {tuple(r) for r in drift.schema_changes(drifted(spark, records)).select("entity", "source_file", "change_kind", "old_path", "new_path").collect()}
    assert found == brute.drift_changes(records, {"works": ["ids", "cby"]})


def test_unified_table(spark, rows):
    records = [("works", file(1), json.dumps({"ids": {"doi": "1", "mid": 7}})), ("works", file(2), json.dumps({"ids": {"doi": "2", "pm": 8}})), ("works", file(3), json.dumps({"ids": {"doi": 3, "pm": 8.5}}))]
    source = lines(spark, records)
    df = drift.unify(source, drift.read_drifting(source, {"works": ["ids", "cby"]}), "works", "ids")
    assert dict(df.dtypes)["ids_mid"] == "double"
    assert rows(df, "record_id", "ids_doi", "ids_mid") == [(0, "1", 7.0), (1, "2", 8.0), (2, "3", 8.5)]


def unified(spark, values, top="ids"):
    source = lines(spark, [("works", file(n), json.dumps({top: v})) for n, v in enumerate(values, 1)])
    return drift.unify(source, drift.read_drifting(source, {"works": ["ids", "cby"]}), "works", top)


def test_fields_that_are_no_renames_keep_their_columns(spark, rows):
    df = unified(spark, [{"pmid": "p", "mag": "m", "doi": "d"}, {"isbn": "i", "doi": "d"}])
    assert rows(df, "record_id", "ids_pmid", "ids_mag", "ids_doi", "ids_isbn") == [(0, "p", "m", "d", None), (1, None, None, "d", "i")]
    # the old name comes back beside the new one
    df = unified(spark, [{"a": "1", "z": "z"}, {"b": "2", "z": "z"}, {"a": "4", "b": "3", "z": "z"}])
    assert rows(df, "record_id", "ids_a", "ids_a_2", "ids_z") == [(0, "1", None, "z"), (1, "2", None, "z"), (2, "3", "4", "z")]


def test_unified_values_of_every_shape(spark, rows):
    df = unified(spark, ["W1", {"a": {"b": True}, "a_b": 2}, {"a": {"b": 2.5}, "a_b": [1, {"x": 2}]}, [{"a": {"b": 7}}, "W2", None, {}, 5], {}, None])
    assert dict(df.dtypes)["ids_a_b"] == "double"
    assert rows(df, "record_id", "item_pos", "ids", "ids_a_b", "ids_a_b_2") == [
        (0, 0, "W1", None, None), (1, 0, None, 1.0, "2"), (2, 0, None, 2.5, '[1,{"x":2}]'), (3, 0, None, 7.0, None), (3, 1, "W2", None, None), (3, 4, "5", None, None)
    ]


def test_a_renamed_parent_carries_its_parts(spark, rows):
    df = unified(spark, [[{"p": {"x": 1}}], [{"q": {"x": 2, "y": 3}}], [{"q": {"w": 4, "y": 5}}]], "cby")
    assert rows(df, "record_id", "cby_p_x", "cby_p_y") == [(0, 1, None), (1, 2, 3), (2, 4, 5)]


def test_drift_empty(spark):
    assert drift.schema_changes(drifted(spark, [])).count() == 0
    assert drift.unify(lines(spark, []), drift.read_drifting(lines(spark, []), {"works": ["ids"]}), "works", "ids").count() == 0


# ---- nested records


def nested(spark, records):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "record_id long, line_text string").select("record_id", F.try_parse_json("line_text").alias("record"))
    return unnest.supertype(df, F.col("record_id"), F.col("record"), q._PARTS)


RECORDS = [
    json.dumps({"authorships": {"author": {"id": "A1"}, "institutions": "https://g/I5"}, "topics": ["T3", None, {"id": "t4"}, {"x": 1}], "grants": [{"funder": {"id": "F1"}}, {"funder": "F2"}, None]}),
    json.dumps({"authorships": json.dumps([None, {"author": "a2", "institutions": [None, "I1", {"id": "I2"}, {"id": None}]}]), "locations": [{"source": None}, {"source": {"id": "S1"}}, {}]}),
    json.dumps({"authorships": [], "topics": None, "grants": "", "locations": "n/a"}),
    json.dumps({"topics": json.dumps({"id": "T9"}), "authorships": [{"institutions": json.dumps({"id": "I7"})}, "A3", 5]}),
    "", None, "broken {", "[1, 2]", '"text"',
]


def test_nested_against_brute_force(spark, rows):
    expected = [x for i, r in enumerate(RECORDS) for x in brute.nested_items(i, r)]
    found = rows(nested(spark, RECORDS), "record_id", "child_table", "parent_pos", "item_pos", "item_key")
    assert found == sorted(expected, key=str)
    assert (1, "institutions", 1, 2, "I2") in found and (0, "authorships", -1, 0, "A1") in found


def test_variant_tables(spark):
    df = spark.createDataFrame([(0, RECORDS[0]), (1, RECORDS[1])], "record_id long, line_text string").select("record_id", F.try_parse_json("line_text").alias("record"))
    parts = unnest.variant_tables(df, F.col("record_id"), F.col("record"), q._PARTS[3])
    assert parts["object(funder=object)"].count() == 1 and parts["object(funder=text)"].count() == 1
    assert parts["object(funder=object)"].columns == ["record_id", "parent_pos", "item_pos", "item_key", "award_id"]


def test_typed_tables_hold_all_items_and_scalars(spark, rows, tmp_path):
    record = {
        "authorships": [
            {"author": {"id": "A1", "display_name": "Ann"}, "author_position": "first", "raw_author_name": "A.", "institutions": [{"id": "I1", "display_name": "Inst", "lineage": ["I1", "I9"]}, "I2"]},
            {"author": json.dumps({"id": "A2", "display_name": "Bo"})},
        ],
        "locations": [{"source": {"id": "S1", "display_name": "Src"}, "is_oa": True, "is_primary": False, "license": "cc", "version": "v1"}],
        "topics": [{"id": "T1", "score": 0.5, "count": 3, "display_name": "Top"}, 5, [1]], "grants": [{"funder": "F1", "award_id": "x"}, {"funder": {"id": "F2", "display_name": "Fund"}}],
    }
    texts = [*RECORDS, json.dumps(record)]
    source = spark.createDataFrame([(i, "works", t) for i, t in enumerate(texts)], "record_id long, entity string, line_text string")
    source.write.parquet(f"{tmp_path}/raw_records.parquet")
    found = q.QUERIES["p7_subtypes"](spark, str(tmp_path))
    shared = ("record_id", "child_table", "parent_pos", "item_pos", "item_key")
    assert rows(found, *shared) == sorted([x for i, t in enumerate(texts) for x in brute.nested_items(i, t)], key=str) == rows(q.p7_found(spark, str(tmp_path)), *shared)
    mine = found.where(F.col("record_id") == len(RECORDS))
    assert rows(mine.where("child_table = 'authorships'"), "variant", "author_position", "raw_author_name", "author_display_name") == [
        ("object(author=object,institutions=absent)", None, None, "Bo"), ("object(author=object,institutions=list)", "first", "A.", "Ann")
    ]
    assert rows(mine.where("child_table = 'institutions'"), "variant", "display_name", "lineage") == [("object", "Inst", ["I1", "I9"]), ("text", None, None)]
    assert rows(mine.where("child_table = 'locations'"), "source_display_name", "is_oa", "is_primary", "license", "version") == [("Src", True, False, "cc", "v1")]
    assert rows(mine.where("child_table = 'topics'"), "variant", "score", "count", "display_name") == [("list", None, None, None), ("object", 0.5, 3, "Top"), ("scalar", None, None, None)]
    assert rows(mine.where("child_table = 'grants'"), "variant", "award_id", "funder_display_name") == [("object(funder=object)", None, "Fund"), ("object(funder=text)", "x", None)]


def test_scalars_of_another_type_make_another_variant(spark, rows, tmp_path):
    text = json.dumps({"locations": [{"is_oa": True, "license": "cc"}, {"is_oa": "yes", "license": {"n": 1}, "version": None}], "topics": [{"id": "T1", "score": 1, "count": 2.5}]})
    source = spark.createDataFrame([(0, "works", text)], "record_id long, entity string, line_text string")
    source.write.parquet(f"{tmp_path}/raw_records.parquet")
    found = q.QUERIES["p7_subtypes"](spark, str(tmp_path))
    assert rows(found, "child_table", "variant", "is_oa", "license", "score", "count", "misfits") == sorted([
        ("locations", "object(source=absent)", True, "cc", None, None, None),
        ("locations", "object(source=absent)!is_oa!license", None, None, None, None, json.dumps({"is_oa": '"yes"', "license": '{"n":1}'}, separators=(",", ":"))),
        ("topics", "object!count", None, None, 1.0, None, '{"count":"2.5"}'),
    ], key=str)
    assert rows(q.p7_found(spark, str(tmp_path)), "item_key") == [("",), ("",), ("T1",)]


def test_nested_empty(spark, tmp_path):
    assert nested(spark, []).count() == 0
    spark.createDataFrame([], "record_id long, entity string, line_text string").write.parquet(f"{tmp_path}/raw_records.parquet")
    assert q.p7_found(spark, str(tmp_path)).count() == q.p7_variants(spark, str(tmp_path)).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 40)), max_size=30))
def test_leaf_bits_hold_all_rows(sizes):
    for n in sizes:
        bits = snapshots.leaf_bits(n or 0, 8)
        assert bits % snapshots.FANOUT_BITS == 0 and 2**bits * 8 >= (n or 0)
