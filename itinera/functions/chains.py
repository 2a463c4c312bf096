"""Token lists and airport chains packed in one text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itinera.functions.text import as_column, blank_to_null, null_tokens, strip_all


def tokens(c: Column | str) -> Column:
    """White-space separated tokens; an empty array for blank or null text."""
    text = strip_all(c)
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(F.split(text, r"\s+"))


def numbered(items: Column, width: int, stem: str, start: int = 1) -> dict[str, Column]:
    """``{stem1: items[0], …}``, null past the end."""
    return {f"{stem}{i + start}": F.get(items, F.lit(i)) for i in range(width)}


def widest(df: DataFrame, items: Column) -> int:
    """Largest array size in the column (one aggregate over the whole column, one number back)."""
    return int(df.agg(F.max(F.size(items)).alias("n")).first()["n"] or 0)


def split_tokens(df: DataFrame, column: str, stem: str, width: int | None = None) -> DataFrame:
    """Replace a token column by numbered columns in its place; the width is measured when not given."""
    items = tokens(F.col(f"`{column}`"))
    width = widest(df, items) if width is None else width
    out: list[Column] = []
    for name in df.columns:
        if name == column:
            out += [value.alias(alias) for alias, value in numbered(items, width, stem).items()]
        else:
            out.append(F.col(f"`{name}`"))
    return df.select(*out)


def hyphenless_flights(c: Column | str) -> Column:
    """Flight tokens with the hyphen between carrier and number removed."""
    return F.transform(tokens(c), lambda t: F.regexp_replace(t, r"([A-Z0-9]{2})-(\d+)", "$1$2"))


def airport_chain_unique(c: Column | str) -> Column:
    """Distinct codes in order of appearance (``LHR/DXB DXB/LHR`` loses the return by design)."""
    codes = F.flatten(F.transform(tokens(null_tokens(c)), lambda t: F.split(t, "/")))
    return F.array_distinct(F.filter(codes, lambda x: x != ""))


def airport_chain_destinations(parts: Column, width: int = 5, compact: bool = True) -> Column:
    """First origin followed by every destination, blank-padded to at least ``width``; longer chains stay whole.

    ``parts`` is an array of ``ORIGIN/DEST`` texts. Elements without a slash are skipped; ``compact`` closes the gap
    they leave, otherwise their destination position stays blank.
    """
    upper = F.transform(parts, lambda p: F.upper(F.trim(p)))
    sector = F.filter(upper, lambda p: F.coalesce(p.contains("/"), F.lit(False)))
    dest = lambda p: F.trim(F.get(F.split(p, "/"), F.lit(1)))
    origin = F.coalesce(F.trim(F.get(F.split(F.get(sector, F.lit(0)), "/"), F.lit(0))), F.lit(""))
    if compact:
        chain = F.when(F.size(sector) > 0, F.concat(F.array(origin), F.transform(sector, dest))).otherwise(
            F.array().cast("array<string>")
        )
    else:
        spaced = F.transform(
            upper, lambda p: F.when(F.coalesce(p.contains("/"), F.lit(False)), dest(p)).otherwise(F.lit(""))
        )
        chain = F.concat(F.array(origin), spaced)
    missing = F.greatest(F.lit(width) - F.size(chain), F.lit(0))
    return F.concat(chain, F.array_repeat(F.lit(""), missing))


def sector_pair(c: Column | str) -> tuple[Column, Column]:
    """Both ends of the first ``A - B`` sector of ``A - B / C - D``."""
    first = F.split_part(null_tokens(c), F.lit("/"), F.lit(1))
    ends = F.split(first, "-")
    return blank_to_null(F.get(ends, F.lit(0))), blank_to_null(F.get(ends, F.lit(1)))


def explode_list(df: DataFrame, column: str, separator: str = ",", out: str | None = None) -> DataFrame:
    """One row per element of a delimited text; null lists give no row. The separator is plain text."""
    quoted = f"\\Q{separator}\\E"
    return df.withColumn(out or column, F.explode(F.split(as_column(column), quoted)))
