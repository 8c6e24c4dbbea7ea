"""Column expressions for record ids.

An entity id is a letter and digits, written bare or at the end of a URL, in any case, with
blanks around it or trailing parts after it.  The *number* is the digit run after the letter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ID = r"(?:^|[^A-Za-z0-9])([A-Za-z])([0-9]+)"


def id_number(col: Column, letter: str | None = None) -> Column:
    """The id's number as a long; null for text that is no id, or of another entity than ``letter``."""
    pattern = _ID if letter is None else rf"(?:^|[^A-Za-z0-9])[{letter.lower()}{letter.upper()}]([0-9]+)"
    return F.regexp_extract(col, pattern, 2 if letter is None else 1).try_cast("long")


def short_id(col: Column) -> Column:
    """``W12`` for any spelling of that id; null for text that is no id."""
    number = id_number(col)
    return F.when(number.isNotNull(), F.concat(F.upper(F.regexp_extract(col, _ID, 1)), number.cast("string")))


def trailing_number(col: Column) -> Column:
    """The digit run that ends the last path segment; null if there is none or it is no long."""
    return F.nullif(F.regexp_extract(F.substring_index(col, "/", -1), r"([0-9]+)$", 1), F.lit("")).try_cast("long")


def last_segment(col: Column) -> Column:
    """The text after the last slash; null for null or empty text."""
    return F.nullif(F.substring_index(F.nullif(col, F.lit("")), "/", -1), F.lit(""))


def slug(col: Column) -> Column:
    """The lower-case last path segment without query, trailing slashes and blanks around it."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(col), r"[?#].*$", ""), r"[/\s]+$", "")
    return F.nullif(F.lower(F.trim(F.substring_index(bare, "/", -1))), F.lit(""))
