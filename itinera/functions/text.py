"""Blank handling and small text rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for "no value" in the extracts.
NULL_TOKENS = ("", "NULL", "None")
NULL_TOKENS_NAN = ("", "nan", "None")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c: Column | str) -> Column:
    """Trim every kind of white space (tabs and newlines too), unlike ``trim``."""
    return F.regexp_replace(as_column(c).cast("string"), r"^\s+|\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip_all(c), F.lit(""))


def null_tokens(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Trimmed text, or null when it is one of the null tokens."""
    text = strip_all(c)
    return F.when(~text.isin(list(tokens)), text)


def strip_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Trim the named text columns and turn blanks into nulls in one projection."""
    return df.withColumns({n: blank_to_null(n) for n in names if n in df.columns})


def first_present(df: DataFrame, *names: str, tokens: Iterable[str] = NULL_TOKENS_NAN) -> Column:
    """The first candidate column that exists in ``df`` and holds a non-blank value in the row."""
    present = {c.lower(): c for c in df.columns}
    found = [null_tokens(F.col(f"`{present[n.lower()]}`"), tokens) for n in names if n.lower() in present]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def first_of_list(c: Column | str, separator: str = ",") -> Column:
    """First element of a delimited list, trimmed; blank becomes null."""
    return blank_to_null(F.split_part(as_column(c), F.lit(separator), F.lit(1)))


def unwrap_literal(c: Column | str) -> Column:
    """Drop one pair of outer brackets, then outer quotes, then unescape double quotes."""
    text = as_column(c)
    inner = F.substring(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))
    bare = F.when(text.startswith("[") & text.endswith("]"), inner).otherwise(text)
    unquoted = F.regexp_replace(bare, "^[\"']+|[\"']+$", "")
    return F.replace(unquoted, F.lit('\\"'), F.lit('"'))


def sectioned_text(parts: Sequence[tuple[str, Column | str]]) -> Column:
    """``Title: value`` blocks separated by blank lines; a null value prints as empty."""
    blocks = [F.concat(F.lit(f"{title}: "), F.coalesce(as_column(c), F.lit(""))) for title, c in parts]
    return F.concat_ws("\n\n", *blocks)


def winner_label(first_wins: Column | str, second_wins: Column | str) -> Column:
    """0 when the first flag is 1, 1 when the second is, otherwise 2."""
    return F.when(as_column(first_wins) == 1, 0).when(as_column(second_wins) == 1, 1).otherwise(2)
