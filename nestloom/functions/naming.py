"""Names of tables, columns, shards and source files."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SUFFIX = r"(?:\.jsonl\.gz|\.jsonl|\.gz)$"


def singular(entity: str) -> str:
    return entity[:-1] if entity.endswith("s") and not entity.endswith("ss") else entity


def target_column(field: str, id_path: str = "id") -> str:
    """The column of a referenced id: named after the last part of its path, or after the field if that is "id"."""
    leaf = id_path.split(".")[-1]
    return f"{field.rstrip('s') if leaf == 'id' else leaf}_id"


def table_path(table: str) -> str:
    """``work_topics`` -> ``works/topics``: the plural of the first part is the folder."""
    cut = table.find("_") if "_" in table else table.find("-")
    head, rest = (table, "") if cut < 0 else (table[:cut], table[cut + 1 :])
    plural = f"{head}es" if head.endswith("ss") else head if head.endswith("s") else f"{head}s"
    return f"{plural}/{rest}" if rest else plural


def source_key(path: str, root: str = "") -> str:
    """``works/updated_date=D/part_1.jsonl.gz`` -> ``works__updated_date=D__part_1``."""
    relative = path[len(root) :].lstrip("/") if root and path.startswith(root) else path
    return re.sub(_SUFFIX, "", relative).replace("/", "__")


def source_key_column(path: Column, root: str = "") -> Column:
    relative = F.regexp_replace(path, f"^{re.escape(root)}/*", "") if root else path
    return F.replace(F.regexp_replace(relative, _SUFFIX, ""), F.lit("/"), F.lit("__"))


def local_name(key: Column) -> Column:
    """The local name of an object-store key: ``.gz`` becomes ``.jsonl.gz``."""
    return F.regexp_replace(key, r"(?<!\.jsonl)\.gz$", ".jsonl.gz")


def readable_size(n: Column) -> Column:
    """Bytes with one decimal in the unit that keeps them under 1,024."""
    size = n.cast("double")
    out = F.format_string("%.1f PB", size / 1024.0**5)
    for power, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(size < 1024.0 ** (power + 1), F.format_string(f"%.1f {unit}", size / 1024.0**power)).otherwise(out)
    return out
