"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Substrings that mark a text as unsafe (case-sensitive).
UNSAFE_SUBSTRINGS = [
    "'", "--", "/*", "*/", "@@",
    "char", "nchar", "varchar", "nvarchar",
    "select", "insert", "update", "delete", "from", "table",
    "drop", "create", "alter", "begin", "end", "grant", "deny",
    "exec", "sp_", "xp_", "cursor", "fetch", "kill", "open",
    "sysobjects", "syscolumns", "sys",
]
# Fixed value: unsafe only as the last character.
UNSAFE_ENDING = "@"


def is_safe(text: Column) -> Column:
    """1 for a text without unsafe parts (also for NULL), else 0.

    A substring that holds another one of the list adds nothing and is not looked for.
    """
    shortest = [s for s in UNSAFE_SUBSTRINGS if not any(o in s for o in UNSAFE_SUBSTRINGS if o != s)]
    unsafe = text.endswith(UNSAFE_ENDING)
    for s in shortest:
        unsafe = unsafe | text.contains(s)
    return F.when(F.coalesce(unsafe, F.lit(False)), 0).otherwise(1)


def part(text: Column, delimiter: str, position: int) -> Column:
    """The n-th part, counted from 1; an empty text where there is none."""
    return F.split_part(text, F.lit(delimiter), F.lit(position))


def general_key(key: Column) -> Column:
    """Alarm key with its module number replaced by 1, as translations are stored."""
    return F.concat(
        F.lit("_"), part(key, "_", 2), F.lit("_1_"), part(key, "_", 4), F.lit("_"), part(key, "_", 5)
    )
