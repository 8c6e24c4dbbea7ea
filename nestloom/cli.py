"""Command line: probe, extract, verify, graph, catalog."""

from __future__ import annotations

import argparse
import json
import sys

from nestloom.operators import graph
from nestloom.plans import catalog, extract, probe
from nestloom.runtime import build_session
from nestloom.sources import files, jsonl


def slice_arguments(total: int | None, index: int | None) -> tuple[int, int] | None:
    """Both or neither, with 0 <= index < total."""
    if total is None and index is None:
        return None
    if total is None or index is None or not 0 <= index < total:
        raise SystemExit("--slice-total and --slice-index go together, and the index is below the total")
    return total, index


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="nestloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("probe", "extract"):
        c = commands.add_parser(name)
        c.add_argument("root")
        c.add_argument("--entity", action="append")
        c.add_argument("--cache")
        c.add_argument("--sample", action="store_true")
        if name == "extract":
            c.add_argument("--out", required=True)
            c.add_argument("--force", action="store_true")
            c.add_argument("--table", action="append", help="write only these tables")
            c.add_argument("--exclude", action="append", default=[])
            c.add_argument("--dry-run", action="store_true", help="print the pending files of each table and write nothing")
            c.add_argument("--lenient", action="store_true", help="go on if data have columns that the schema lacks")
            c.add_argument("--no-verify", action="store_true", help="do not look for damaged files")
            c.add_argument("--slice-total", type=int)
            c.add_argument("--slice-index", type=int)
    c = commands.add_parser("verify")
    c.add_argument("root", help="folder of compressed files")
    c = commands.add_parser("graph")
    c.add_argument("tables", help="folder with <entity>/<table>")
    c.add_argument("--relation", action="append", help="all registered ones by default")
    c.add_argument("--out", required=True)
    c.add_argument("--force", action="store_true")
    c.add_argument("--combined", action="store_true", help="one graph of all relations, instead of one of each")
    c.add_argument("--collapse", action="store_true", help="equal numbers of different entities are one node")
    c = commands.add_parser("catalog")
    c.add_argument("tables")
    c.add_argument("--sample", type=int, help="estimate rows from the footers of this many files a table")
    c.add_argument("--readme", help="put the header into this file instead of printing it")
    a = parser.parse_args(arguments)
    spark = build_session()
    show = lambda df: [print(json.dumps(r.asDict(), default=str)) for r in df.collect()]
    if a.command in ("probe", "extract"):
        for entity in a.entity or jsonl.entities(a.root):
            schema = probe.entity_schema(spark, a.root, entity, a.cache, a.sample)
            if a.command == "probe":
                print(schema.to_json())
                continue
            part = slice_arguments(a.slice_total, a.slice_index)
            if a.dry_run:
                show(extract.pending_files(spark, a.root, schema, a.out, a.force, a.table, a.exclude, part))
            else:
                show(extract.extract(spark, a.root, schema, a.out, a.force, a.table, a.exclude, part, not a.lenient, not a.no_verify))
    elif a.command == "verify":
        damaged = jsonl.verify(spark, a.root).where("NOT ok")
        show(damaged)
        return int(damaged.count() > 0)
    elif a.command == "graph" and a.combined:
        graph.export(graph.build(graph.combined(graph.read_relations(spark, a.tables, a.relation or graph.EDGE_TABLES), not a.collapse)), a.out)
    elif a.command == "graph":
        built = graph.build_all(spark, a.tables, a.out, a.relation, a.force)
        show(built)
        show(graph.status_counts(built))
    else:
        header = catalog.front_matter(catalog.catalog(spark, a.tables, a.sample))
        if a.readme:
            files.write_text(a.readme, catalog.spliced(files.read_text(a.readme) or "", header))
        else:
            print(header)
    return 0


if __name__ == "__main__":
    sys.exit(main())
