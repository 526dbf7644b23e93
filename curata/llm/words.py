"""Word rules shared by the native operators, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed by the operators' contracts: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array (null: empty)."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    """The number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
