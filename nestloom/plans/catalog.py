"""Descriptions of written tables: features, sizes, and the header of a dataset card."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from nestloom.sources import files

#: The order of entities in a catalog.
ENTITY_ORDER = ("works", "authors", "institutions", "sources", "publishers", "funders", "concepts", "topics", "subfields", "fields", "domains")

_NAMES = {
    T.StringType: "string", T.LongType: "int64", T.IntegerType: "int32", T.ShortType: "int16", T.ByteType: "int8", T.DoubleType: "float64", T.FloatType: "float32",
    T.BooleanType: "bool", T.BinaryType: "binary", T.DateType: "date32", T.TimestampType: "timestamp[us]",
}


def feature(kind: T.DataType) -> object:
    """A type as dataset cards write it: a name, a sequence, or a list of named fields."""
    if isinstance(kind, T.ArrayType):
        return {"sequence": feature(kind.elementType)}
    if isinstance(kind, T.StructType):
        return {"struct": [{"name": f.name, "dtype": feature(f.dataType)} for f in kind.fields]}
    return _NAMES.get(type(kind), "string")


def table_info(spark: SparkSession, folder: str, sample: int | None = None) -> dict:
    """Features, rows, bytes and files of a table; rows come from the files' footers, or are estimated from those of ``sample`` files."""
    listed = [f for f in files.walk(folder, ".parquet") if not os.path.basename(f.path).startswith((".", "_"))]
    df = spark.read.parquet(folder)
    if sample is None or len(listed) <= sample:
        rows = df.count()
    else:
        some = files.checked(spark, [f.path for f in spread(listed, sample)], files.footer, "ok boolean, n_rows long").where("ok")
        rows = estimated_rows([r["n_rows"] for r in some.collect()], len(listed))
    return {"features": [{"name": f.name, "dtype": feature(f.dataType)} for f in df.schema.fields], "num_rows": rows, "num_bytes": sum(f.n_bytes for f in listed), "num_shards": len(listed)}


def spread(of: list, most: int) -> list:
    """At most ``most`` of a list, evenly spread, with both ends."""
    return of if len(of) <= most else [of[i * (len(of) - 1) // max(1, most - 1)] for i in range(most)]


def estimated_rows(sampled: list[int], n_files: int) -> int:
    """Rows of all files from those of a sample."""
    return int(sum(sampled) / len(sampled) * n_files) if sampled else 0


def shard_check(spark: SparkSession, folder: str) -> DataFrame:
    """``path, ok, n_rows`` of a table's files: whether each one's footer can be read."""
    return files.checked(spark, [f.path for f in files.walk(folder, ".parquet")], files.footer, "ok boolean, n_rows long")


def catalog(spark: SparkSession, root: str, sample: int | None = None) -> dict[str, dict]:
    """The tables below ``root/<entity>/<table>``, by configuration name: known entities in their order, then others by name."""
    place = {e: i for i, e in enumerate(ENTITY_ORDER)}
    names = [name for name, folder in files.children(root) if folder and name[0] not in "._"]
    out = {}
    for entity in sorted(names, key=lambda e: (place.get(e, len(place)), e)):
        for name, folder in files.children(f"{root}/{entity}"):
            if folder and name[0] not in "._" and not name.startswith("updated_date=") and files.walk(f"{root}/{entity}/{name}", ".parquet"):
                out[f"{entity}_{name}"] = table_info(spark, f"{root}/{entity}/{name}", sample)
    return out


def _text(value: object) -> str:
    text = str(value)
    return f'"{text}"' if text in ("true", "false", "null", "yes", "no", "") or ":" in text or "#" in text else text


def _lines(value: object, indent: str = "") -> list[str]:
    if isinstance(value, dict):
        out = []
        for k, v in value.items():
            out += [f"{indent}{k}:", *_lines(v, indent + "  ")] if isinstance(v, dict | list) else [f"{indent}{k}: {_text(v)}"]
        return out
    out = []
    for item in value:
        first, *rest = _lines(item, indent + "  ") if isinstance(item, dict | list) else [indent + "  " + _text(item)]
        out += [f"{indent}- {first.strip()}", *rest]
    return out


def front_matter(tables: dict[str, dict]) -> str:
    """The YAML of a dataset card: the features and sizes of every table and where its files are."""
    infos = [{"config_name": n, "features": t["features"], "splits": [{"name": "train", "num_bytes": t["num_bytes"], "num_examples": t["num_rows"]}], "dataset_size": t["num_bytes"]} for n, t in tables.items()]
    configs = [{"config_name": n, "data_files": [{"split": "train", "path": f"{n.replace('_', '/', 1)}/**/*.parquet"}]} for n in tables]
    return "\n".join(_lines({"dataset_info": infos, "configs": configs})) + "\n"


def spliced(readme: str, header: str) -> str:
    """A card with its YAML header replaced, or put in front if it has none."""
    body = readme.removeprefix("﻿")
    stripped = body.lstrip("\r\n ")
    if stripped.startswith("---\n") and (end := stripped.find("\n---", 3)) >= 0:
        rest = stripped[end + 4 :]
        body = rest[rest.find("\n") + 1 :] if "\n" in rest else ""
    return f"---\n{header}---\n{body}"
