"""Types, names, inference, patterns, graphs, incremental runs and streams."""

import gzip
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestloom import cli, queries_general, runtime
from nestloom.functions import lattice, naming
from nestloom.operators import graph
from nestloom.plans import catalog, extract, incremental, probe
from nestloom.plans.compile import UnexpectedColumns, check_columns, tables
from nestloom.plans.schema import Field, Schema, load, merge, store
from nestloom.sources import jsonl
from nestloom.streaming import ingest


def records(spark, data, key="f"):
    df = spark.createDataFrame([(key, json.dumps(r) if not isinstance(r, str | None) else r) for r in data], "source_key string, line string")
    return df.select("source_key", "line", jsonl.parse(F.col("line")).alias("record"))


def build(spark, data, entity="works", **options):
    r = records(spark, data)
    schema = probe.probe(r, entity, **options)
    return schema, {k: sorted((tuple(x)[:-1] for x in d.collect()), key=str) for k, d in tables(r, schema).items()}


# ---- lattice and names


@pytest.mark.parametrize(
    ("types", "wide"),
    [((), "str"), (("str",), "str"), (("int",), "int"), (("float",), "float"), (("bool",), "bool"), (("int", "float"), "float"), (("bool", "int"), "int"), (("bool", "float"), "float"), (("int", "str"), "str"), (("bool", "int", "float", "str"), "str")],
)
def test_widening(types, wide):
    assert lattice.widen(types) == wide


def test_number_texts(spark):
    values = [1.0, 0.5, 1e-5, 1.5e-7, 1e16, 12345678.0, 1e15, 0.0001, 123456.789, -2.0, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(lattice.number_text(F.col("x"))).collect()] == [str(v) for v in values]


def test_scalar_texts(spark):
    df = spark.createDataFrame([("true",), ("12",), ('"a"',), ("1.5",), ("null",), ("[1]",), (None,)], "x string").select(lattice.scalar_text(F.try_parse_json("x")))
    assert [r[0] for r in df.collect()] == ["True", "12", "a", "1.5", None, None, None]


def test_names():
    assert [naming.singular(x) for x in ("works", "countries", "class")] == ["work", "countrie", "class"]
    assert naming.target_column("authorships", "author.id") == "authorship_id"
    assert naming.target_column("corresponding_author_ids") == "corresponding_author_id_id"
    assert naming.target_column("addresses") == "addresse_id"
    assert naming.target_column("x", "institution.ror") == "ror_id"
    assert [naming.table_path(x) for x in ("work_topics", "class_a", "works", "news_b", "a-b")] == ["works/topics", "classes/a", "works", "news/b", "as/b"]
    assert naming.source_key("/r/works/updated_date=2024-01-09/part_0047.jsonl.gz", "/r") == "works__updated_date=2024-01-09__part_0047"


# ---- inference


def test_sparse_fields_and_skipped_parts(spark):
    schema, _ = build(spark, [{"id": "I1"}, {"id": "I2", "lineage": []}, {"id": "I3", "lineage": ["https://h/I3"], "xs": [{"id": "https://h/I1"}, {"id": "https://h/I2", "rank": 2, "countries": ["A"]}]}], "institutions")
    fields = {f.key: f for f in schema.fields}
    assert fields["lineage"].pattern == "url_list" and fields["xs"].extras == ("rank",)


SMOKE = {
    "id": "https://h/W5", "title": "t", "is_oa": True, "n": 3,
    "authorships": [{"author": {"id": "https://h/A7", "display_name": "x"}, "author_position": "first", "raw_author_name": "x", "institutions": [{"id": "https://h/I2"}, {"id": "slug"}]}, {"author": {"id": None}, "institutions": [{"id": "https://h/I9"}]}],
    "referenced_works": ["https://h/W1", "bad", None, 4], "topics": [{"id": "https://h/T1", "score": 0.5, "count": 2, "display_name": "d", "subfield": {"id": "https://h/subfields/9"}}],
    "keywords": [{"id": "https://h/keywords/covid-19", "score": 0.25}], "grants": [{"funder": "https://h/F3", "award_id": "z"}, {"funder": "none"}],
    "locations": [{"source": {"id": "https://h/S4"}, "is_oa": True, "license": None}, {"source": None, "license": "by"}], "primary_location": {"source": {"id": "https://h/S4"}},
    "mesh": [{"descriptor_ui": "D1", "descriptor_name": "n", "is_major_topic": True}], "counts_by_year": [{"year": 2020, "cited_by_count": 2}, {"year": 2021, "cited_by_count": "5"}, {"year": None, "cited_by_count": 1}],
    "ids": {"doi": "x", "mag": 7, "pmid": "", "ok": True, "no": False}, "indexed_in": ["a", ""], "abstract_inverted_index": {"w": [0, 2]}, "awards": [{"id": "https://h/G1", "funder_id": "https://h/F1", "display_name": "n"}],
    "open_access": {"status": "gold", "any": {"deep": 1.5}}, "codes": ["c"], "numbers": [1, 2],
}


def test_all_tables_of_a_record(spark):
    schema, found = build(spark, [SMOKE])
    assert found["work_authorships"] == [(5, 7, "first")]
    assert found["work_authorships_institutions"] == [(5, 7, 2)]
    assert found["work_referenced_works"] == [(5, 1), (5, 4)]
    assert found["work_topics"] == [(5, 1, 0.5, 2)]
    assert found["work_keywords"] == [(5, "covid-19", 0.25)]
    assert found["work_funders"] == [(5, 3, "z")]
    assert found["work_locations"] == [(5, 4, True, None), (5, None, None, "by")]
    assert found["work_mesh"] == [(5, "D1", "n", None, None, True)]
    assert found["work_counts_by_year"] == [(5, 2020, 2), (5, 2021, 0)]
    assert found["work_external_ids"] == [(5, "doi", "x"), (5, "mag", "7"), (5, "ok", "True")]
    assert found["work_indexed_in"] == [(5, "a")] and found["work_codes"] == [(5, "c")]
    assert found["work_abstracts"] == [(5, "w", [0, 2])]
    assert found["work_awards"] == [(5, 1, "n", None, 1, None)]
    main = dict(zip([c for c, _ in schema.tables["work_main"]], found["work_main"][0], strict=True))
    assert main == {"work_id": 5, "title": "t", "is_oa": True, "n": 3, "open_access_status": "gold", "open_access_any_deep": 1.5}
    assert not any("primary" in t or "numbers" in t for t in schema.table_names())


YEARS = [{"year": 1999, "works_count": 4, "cited_by_count": 6, "oa_works_count": 1}]
# entity -> (a record, its tables)
ENTITIES = {
    "sources": (
        {
            "id": "https://h/S31", "host_organization_lineage": ["https://h/P5", "https://h/P6"], "societies": [{"organization": "Guild of Bells", "url": "https://bells"}, {"organization": ""}],
            "counts_by_year": YEARS, "ids": {"issn_l": "1111-2222"}, "issn": ["1111-2222", None], "apc_prices": [{"price": 12, "currency": "EUR"}], "alternate_titles": ["Bells"],
            "topic_share": [{"id": "https://h/T8", "value": 0.25, "domain": {"id": "d"}, "field": {}, "subfield": {}}],
        },
        {
            "source_host_organization_lineage": [(31, 5), (31, 6)], "source_societies": [(31, "Guild of Bells", "https://bells")], "source_counts_by_year": [(31, 1999, 4, 6, 1)], "source_external_ids": [(31, "issn_l", "1111-2222")],
            "source_issns": [(31, "1111-2222")], "source_apc_prices": [(31, 12.0, "EUR")], "source_alternate_titles": [(31, "Bells")], "source_topic_share": [(31, 8, 0.25)],
        },
    ),
    "funders": (
        {"id": "https://h/F4", "roles": [{"id": "https://h/P9", "role": "publisher"}, {"id": "https://h/X9", "role": "other"}], "counts_by_year": YEARS, "alternate_titles": ["Bell Fund"]},
        {"funder_roles": [(4, 9, "other", ""), (4, 9, "publisher", "P")], "funder_counts_by_year": [(4, 1999, 4, 6, 1)], "funder_alternate_titles": [(4, "Bell Fund")]},
    ),
    "institutions": (
        {"id": "https://h/I7", "repositories": [{"id": "https://h/S2", "display_name": "Shelf"}], "display_name_acronyms": ["BI"], "roles": [{"id": "https://h/F4", "role": "funder"}]},
        {"institution_repositories": [(7, 2)], "institution_display_name_acronyms": [(7, "BI")], "institution_roles": [(7, 4, "funder", "F")]},
    ),
    "subfields": (
        {"id": "https://h/subfields/12", "field": {"id": "https://h/fields/3", "display_name": "f"}, "domain": {"id": "https://h/domains/1", "display_name": "d"}, "display_name_alternatives": ["alt"]},
        {"subfield_fields": [(12, 3)], "subfield_domains": [(12, 1)], "subfield_display_name_alternatives": [(12, "alt")]},
    ),
    "fields": ({"id": "https://h/fields/3", "domain": {"id": "https://h/domains/1", "display_name": "d"}, "ids": {"x": "y"}}, {"field_domains": [(3, 1)], "field_external_ids": [(3, "x", "y")]}),
    "domains": ({"id": "https://h/domains/1", "ids": {"x": "y"}, "display_name_alternatives": ["alt"]}, {"domain_external_ids": [(1, "x", "y")], "domain_display_name_alternatives": [(1, "alt")]}),
    "sdgs": ({"id": "https://h/sdgs/13", "ids": {"un": "https://un/13"}}, {"sdg_external_ids": [(13, "un", "https://un/13")]}),
    "awards": (
        {
            "id": "https://h/G2", "funded_outputs": ["https://h/W6", "https://h/W7"], "investigators": [{"given_name": "Ada", "family_name": "Quill", "orcid": None, "affiliation": None}],
            "lead_investigator": {"given_name": "Io", "family_name": "Marsh", "orcid": "0-1", "affiliation": {"name": "Inst", "country": "NL", "ids": [{"id": "I1", "type": "ror", "asserted_by": "x"}]}},
            "co_lead_investigator": {"given_name": "Bo", "family_name": "Fen", "orcid": None, "affiliation": "Plain Text"},
        },
        {
            "award_funded_outputs": [(2, 6), (2, 7)], "award_investigator_affiliations": [(2, "0-1", "Marsh", "I1", "ror", "x")],
            "award_investigators": [(2, "Ada", "Quill", None, None, None, None, False, False), (2, "Bo", "Fen", None, "Plain Text", None, None, False, True), (2, "Io", "Marsh", "0-1", "Inst", "NL", None, True, False)],
        },
    ),
}


@pytest.mark.parametrize("entity", ENTITIES)
def test_tables_of_every_entity(spark, entity):
    record, expected = ENTITIES[entity]
    _, found = build(spark, [record], entity)
    assert {t: found.get(t) for t in expected} == expected
    assert {t for t, rows in found.items() if rows} == set(expected)


def test_topic_by_its_own_or_the_inner_id(spark):
    assert build(spark, [SMOKE])[1]["work_topics"][0][1] == 1
    assert build(spark, [SMOKE], prefer_own_id=False)[1]["work_topics"][0][1] == 9


def test_people(spark):
    person = {"given_name": "g", "family_name": "f", "orcid": None}
    schema, found = build(
        spark, [{"id": "G1", "lead_investigator": {**person, "affiliation": {"name": "n", "country": "c", "ids": [{"id": "i", "type": "t", "asserted_by": "b"}]}}, "co_lead_investigator": {**person, "affiliation": "plain"}, "investigators": [{**person, "affiliation": None}]}], "awards"
    )
    assert {r[4:6] + r[7:] for r in found["award_investigators"]} == {("n", "c", True, False), ("plain", None, False, True), (None, None, False, False)}
    assert found["award_investigator_affiliations"] == [(1, None, "f", "i", "t", "b")]


def test_slug_ids_make_a_text_column(spark):
    schema, found = build(spark, [{"id": "https://h/languages/en", "display_name": "E"}, {"id": "https://h/languages/x1", "display_name": "X"}, {"display_name": "none"}], "languages")
    assert schema.id_type == "str" and found["language_main"] == [("1", "X"), ("en", "E")]


def test_mixed_types_widen(spark):
    schema, found = build(spark, [{"id": "W1", "a": 1, "b": True}, {"id": "W2", "a": "x", "b": 2}, {"id": "W3", "a": 1.5, "b": None}])
    assert dict(schema.tables["work_main"]) == {"work_id": "int", "a": "str", "b": "int"}
    assert found["work_main"] == [(1, "1", 1), (2, "x", 2), (3, "1.5", None)]


def test_unreadable_lines_are_counted(spark):
    r = records(spark, [{"id": "W1"}, "", " ", None, "{broken", "[1]"])
    assert tuple(jsonl.losses(r).first()) == ("f", 1, 3, 2)


def test_schema_round_trip_merge_and_store(spark, tmp_path):
    schema, _ = build(spark, [SMOKE])
    assert Schema.from_json(schema.to_json()) == schema
    path = str(tmp_path / "s" / "works.json")
    store(schema, path)
    assert load(path, "works") == schema and load(path, "authors") is None and load(str(tmp_path / "none"), "works") is None
    with open(path, "w") as f:
        f.write(schema.to_json().replace('"version": 1', '"version": 99'))
    assert load(path, "works") is None
    seen = Schema("works", (Field("a", "scalar", "work_main", columns=(("a", "a", "int"),)),))
    both = merge(schema, seen)
    assert {f.key for f in schema.fields} <= {f.key for f in both.fields} | {"a"} and both.fields[0].key == "a"
    assert merge(Schema("works", id_type="str"), seen).id_type == "str"


def test_unexpected_columns_are_named(spark):
    old, _ = build(spark, [{"id": "W1", "xs": [{"a": 1}]}])
    new, _ = build(spark, [{"id": "W1", "xs": [{"a": 1, "b": 2}]}])
    with pytest.raises(UnexpectedColumns, match="work_xs.b"):
        check_columns(new, old)
    check_columns(old, new)


def test_empty_lists_by_name(spark):
    schema, found = build(spark, [{"id": "W1", "ids": None, "issn": [], "grants": [], "doi": None}])
    assert {f.table for f in schema.fields} == {"work_external_ids", "work_issns", "work_funders"}
    assert all(not rows for rows in found.values())


# ---- files


def snapshot(root, files):
    for name, data in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with gzip.open(path, "wt") as f:
            f.writelines(json.dumps(r) + "\n" for r in data)


def grain(n, name, **more):
    return {"id": f"https://h/grains/G{n}", "name": name, **more}


@pytest.fixture
def granary(spark, tmp_path):
    """A root with one file, its schema, and a function that runs the extraction."""
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    snapshot(root, {"grains/updated_date=2023-05-07/part_7.jsonl.gz": [grain(n, f"g{n}", pests=[{"id": "https://h/X1"}] * (n == 3)) for n in (3, 4, 5)], "_x/a.gz": [{}]})
    schema = probe.entity_schema(spark, root, "grains", str(tmp_path / "cache"))
    run = lambda **o: {r["table_name"]: (r["status"], r["n_files"]) for r in extract.extract(spark, root, schema, out, **o).collect()}
    names = lambda: sorted(r["grain_id"] for r in spark.read.parquet(f"{out}/grains/main").collect())
    return root, out, schema, run, names


def test_files_are_extracted_once(spark, granary, tmp_path):
    root, out, schema, run, names = granary
    assert jsonl.entities(root) == ["grains"] and probe.entity_schema(spark, root, "grains", str(tmp_path / "cache")) == schema
    assert [tuple(r)[:2] for r in extract.pending_files(spark, root, schema, out).collect()] == [("grain_main", 1), ("grain_pests", 1)]
    assert run() == {"grain_main": ("written", 1), "grain_pests": ("written", 1)}
    assert run() == {"grain_main": ("skipped", 0), "grain_pests": ("skipped", 0)}
    # a new file, and one that has changed
    snapshot(root, {"grains/updated_date=2023-06-01/part_7.jsonl.gz": [grain(9, "g9")]})
    assert run()["grain_main"] == ("written", 1)
    snapshot(root, {"grains/updated_date=2023-05-07/part_7.jsonl.gz": [grain(3, "other name altogether"), grain(4, "y")]})
    assert run(exclude=["grain_pests"]) == {"grain_main": ("written", 1)} and names() == [3, 4, 9]
    assert run(force=True, wanted=["grain_main"]) == {"grain_main": ("written", 2)}
    snapshot(root, {"grains/updated_date=2023-06-01/part_7.jsonl.gz": [{"name": "no id"}]})
    assert run()["grain_main"] == ("written", 1) and names() == [3, 4]
    main, marks = spark.read.parquet(f"{out}/grains/main"), extract.done(spark, out, "grain_main")
    assert extract.validate(main, marks).count() == 0 and extract.content_hash(main).count() == 1
    totals = {r["table_name"]: tuple(r)[1:5] for r in extract.status_totals(spark, out, ["grain_main", "grain_pests"]).collect()}
    assert totals == {"grain_main": (1, 1, 0, 2), "grain_pests": (0, 2, 0, 0)}
    assert all(r["ok"] for r in catalog.shard_check(spark, f"{out}/grains/main").collect())
    assert {r["schema_fingerprint"] for r in marks.collect()} == {schema.fingerprint}


def test_unknown_columns_stop_the_extraction(spark, granary):
    root, out, schema, run, _ = granary
    snapshot(root, {"grains/updated_date=2023-06-01/part_7.jsonl.gz": [grain(9, "g9", color="red", pests=[])]})
    with pytest.raises(UnexpectedColumns, match="grain_main.color"):
        run()
    assert not os.path.exists(f"{out}/grains")
    assert run(strict=False)["grain_main"] == ("written", 2)


def test_damaged_files_are_marked_and_the_rest_goes_on(spark, granary):
    root, out, schema, run, names = granary
    snapshot(root, {"grains/updated_date=2023-06-01/part_7.jsonl.gz": [grain(n, os.urandom(200).hex()) for n in range(1000, 4000)]})
    path = f"{root}/grains/updated_date=2023-06-01/part_7.jsonl.gz"
    with open(path, "rb") as f:
        content = f.read()
    with open(path, "wb") as f:
        f.write(content[: len(content) // 2])
    found = {r["table_name"]: r["n_damaged"] for r in extract.extract(spark, root, schema, out).collect()}
    assert found == {"grain_main": 1, "grain_pests": 1}
    assert {3, 4, 5, 1000} <= set(names()) and len(names()) < 3003
    assert sorted(r["status"] for r in extract.done(spark, out, "grain_main").collect()) == ["complete", "damaged"]
    assert jsonl.read(spark, [path, f"{root}/grains/gone.gz"][:1], root).count() > 100


def test_catalog(spark, granary):
    root, out, schema, run, _ = granary
    run()
    card = catalog.front_matter(catalog.catalog(spark, out))
    assert "grains_main" in card and "num_examples: 3" in card
    assert catalog.spliced("﻿\n---\nold: 1\n---\nbody\n", "new: 1\n") == "---\nnew: 1\n---\nbody\n" and catalog.spliced("body", "a: 1\n") == "---\na: 1\n---\nbody"
    spark.range(100).repartition(10).write.parquet(f"{out}/works/many")
    info = catalog.table_info(spark, f"{out}/works/many", sample=3)
    assert (info["num_shards"], abs(info["num_rows"] - 100) <= 20) == (10, True)
    assert list(catalog.catalog(spark, out)) == ["works_many", "grains_main", "grains_pests"]


def test_command_line(spark, granary, capsys, tmp_path):
    root, out, *_ = granary
    said = lambda *a: (cli.main(list(a)), capsys.readouterr().out)
    assert "grain_pests" in said("probe", root)[1]
    assert '"n_files": 1' in said("extract", root, "--out", out, "--dry-run")[1] and not os.path.exists(out)
    assert '"written"' in said("extract", root, "--out", out, "--exclude", "grain_pests")[1] and not os.path.exists(f"{out}/grains/pests")
    assert said("verify", root) == (0, "")
    with open(f"{root}/bad.gz", "wb") as f:
        f.write(b"no gzip")
    assert said("verify", root)[0] == 1
    spark.createDataFrame([(1, 2)], "work_id long, topic_id long").write.parquet(f"{out}/works/topics")
    assert '"built": 1' in said("graph", out, "--out", f"{tmp_path}/g", "--relation", "work_topics")[1]
    said("graph", out, "--out", f"{tmp_path}/all", "--combined")
    assert spark.read.parquet(f"{tmp_path}/all/ids").count() == 2
    said("catalog", out, "--readme", f"{tmp_path}/README.md")
    assert "works_topics" in (tmp_path / "README.md").read_text()
    with pytest.raises(SystemExit):
        cli.slice_arguments(2, 2)


def test_hashes_and_manifests(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc")
    assert tuple(incremental.file_hashes(spark, [str(tmp_path / "a")]).first()) == (str(tmp_path / "a"), 3, "ba7816bf8f01cfea")
    paths = spark.createDataFrame([("a",), ("b",)], "path string")
    assert incremental.in_manifest(paths, None).count() == 2 and incremental.in_manifest(paths, paths.where("path = 'a'")).count() == 1
    sizes = spark.createDataFrame([("a", 5), ("b", 7)], "path string, n long")
    changes = spark.createDataFrame([("a", "added"), ("b", "added"), ("c", "removed")], "path string, change string")
    assert sorted(tuple(r) for r in incremental.totals(changes, sizes, "path", "n").collect()) == [("added", 2, 12), ("removed", 1, 0)]


def test_a_shared_folder_is_needed_off_one_machine():
    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = type("S", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: {})})  # noqa: N815

    with pytest.raises(RuntimeError, match="checkpoint"):
        runtime.shared_dir(Elsewhere())


def test_repeated_keys(spark, tmp_path):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    spark.createDataFrame([(1, "works", '{"topics": ["T1"], "topics": ["T2"]}')], "record_id long, entity string, line_text string").write.parquet(f"{tmp_path}/raw_records.parquet")
    assert [r["item_key"] for r in queries_general.p7_found(spark, str(tmp_path)).collect()] == ["T2"]


def test_stream_takes_each_file_once(spark, tmp_path):
    root, out, point = (str(tmp_path / x) for x in ("in", "out", "point"))
    schema = Schema("topics", (Field("name", "scalar", "topic_main", columns=(("name", "name", "str"),)),), tables={"topic_main": (("topic_id", "int"), ("name", "str"))})
    for n in (1, 2):
        snapshot(root, {f"topics/updated_date=2020-01-0{n}/part_0.jsonl.gz": [{"id": f"T{n}", "name": "x"}]})
        ingest.ingest(spark, root, schema, out, point).awaitTermination()
        assert spark.read.parquet(f"{out}/topics/main").count() == n
    ingest.ingest(spark, root, schema, out, point).awaitTermination()
    assert spark.read.parquet(f"{out}/topics/main").count() == 2


def test_damaged_file_is_a_row(spark, tmp_path):
    snapshot(str(tmp_path), {"a.gz": [{"id": "x" * 1000}] * 50})
    content = (tmp_path / "a.gz").read_bytes()
    (tmp_path / "b.gz").write_bytes(content[: len(content) // 2])
    found = {os.path.basename(r["path"]): r["ok"] for r in jsonl.verify(spark, str(tmp_path)).collect()}
    assert found == {"a.gz": True, "b.gz": False}


# ---- graphs and plans


def links(spark, data):
    return graph.ends(spark.createDataFrame(data, "a long, b long"), "a", "b")


def test_graph(spark, rows):
    g = graph.build(links(spark, [(5, 7), (5, 7), (5, 6), (9, None), (None, 3), (6, 5)]))
    assert list(g) == ["ids", "edges", "rows"]
    assert rows(g["ids"], "id", "idx") == [(3, 0), (5, 1), (6, 2), (7, 3), (9, 4)]
    assert rows(g["edges"], "src_idx", "tgt_idx") == [(1, 2), (1, 3), (2, 1)]
    assert rows(g["rows"]) == [(0, 0, 0), (1, 2, 2), (2, 1, 3), (3, 0, 3), (4, 0, 3)]
    assert rows(graph.neighbours(g["edges"])) == [(1, 0, 2), (1, 1, 3), (2, 0, 1)]
    assert rows(graph.row_pointers(g["edges"], g["ids"], block=2)) == rows(g["rows"])


def test_graph_without_edges(spark):
    g = graph.build(links(spark, [(1, None)]))
    assert [g[k].count() for k in ("ids", "edges", "rows")] == [0, 0, 0]


def test_combined_graph(spark):
    a = spark.createDataFrame([(1, 1)], "work_id long, authorship_id long")
    assert graph.nodes_of(graph.combined({"work_authorships": a})).count() == 2
    assert graph.nodes_of(graph.combined({"work_authorships": a}, namespaced=False)).count() == 1
    with pytest.raises(graph.NotAGraph):
        graph.combined({"nothing": a})
    with pytest.raises(RuntimeError):
        graph.combined({})


def test_every_registered_relation_is_a_graph(spark, tmp_path):
    for name, (_, (space, _)) in graph.EDGE_TABLES.items():
        source, target = (c for _, c in graph.EDGE_TABLES[name])
        extra = ", 'F' AS role_prefix" if space == "" else ""
        spark.sql(f"SELECT 1 AS {source}, 2 AS {target}{extra}").write.parquet(f"{tmp_path}/t/{naming.table_path(name)}")
    built = graph.build_all(spark, f"{tmp_path}/t", f"{tmp_path}/g", [*list(graph.EDGE_TABLES)[-4:], "nothing", "work_main"]).collect()
    assert [r["status"] for r in built] == ["built"] * 4 + ["failed"] * 2 and {r["n_edges"] for r in built} == {1, None}
    again = graph.build_all(spark, f"{tmp_path}/t", f"{tmp_path}/g", ["publisher_roles", "concept_ancestors"])
    assert [r["status"] for r in again.collect()] == ["skipped"] * 2 and tuple(graph.status_counts(again).first()) == (0, 2, 0)
    assert graph.build_all(spark, f"{tmp_path}/t", f"{tmp_path}/g", ["concept_ancestors"], force=True).first()["status"] == "built"
    warned = []
    frames = graph.read_relations(spark, f"{tmp_path}/t", graph.EDGE_TABLES)
    assert graph.edges_of(graph.combined(frames)).count() == len({(s[0], t[0] or "F") for s, t in graph.EDGE_TABLES.values()})
    assert graph.read_relations(spark, f"{tmp_path}/none", ["work_topics"], warned.append) == {} and warned
    with pytest.raises(graph.NotAGraph):
        graph.read_relations(spark, f"{tmp_path}/t", ["nothing"])


def test_npz(spark, tmp_path):
    graph.export_npz(graph.build(links(spark, [(5, 7), (5, 6), (6, 5)])), f"{tmp_path}/g.npz")
    held = np.load(f"{tmp_path}/g.npz")
    assert held["indptr"].tolist() == [0, 2, 3, 3] and held["indices"].tolist() == [1, 2, 0] and held["shape"].tolist() == [3, 3]
    assert np.load(f"{tmp_path}/g_ids.npy").tolist() == [5, 6, 7]
    with pytest.raises(ValueError, match="too many"):
        graph.export_npz(graph.build(links(spark, [(5, 7)])), f"{tmp_path}/h.npz", most=2)


def test_frequent_keys_are_looked_up_apart(spark, rows):
    facts = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id")
    lookup = spark.range(0, 900).selectExpr("id AS k", "id * 2 AS v")
    assert rows(runtime.looked_up(facts, lookup, ["k"], share=10, least=5), "k", "id", "v") == rows(facts.join(lookup, "k"), "k", "id", "v")


def test_plans():
    assert incremental.bin_pack([("a", 5), ("b", 4), ("c", 3), ("d", 1)], 2) == [["a", "d"], ["b", "c"]]
    assert incremental.bin_pack([], 2) == [[], []]
    assert incremental.batches(0, 18) == 0 and incremental.batches(100, 18) == 3


def test_slices(spark):
    df = spark.createDataFrame([(x,) for x in "bdace"], "k string")
    assert sorted(r[0] for r in incremental.in_slice(df, "k", 2, 1).collect()) == ["b", "d"]
    with pytest.raises(ValueError, match="slice"):
        incremental.in_slice(df, "k", 2, 2)


def test_entry_module():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "csr_indptr" in e.queries()
