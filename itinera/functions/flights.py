"""Flight-number normalisers, placeholder tests and validity rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from itinera.functions.text import NULL_TOKENS, as_column, null_tokens, strip_all

# Carrier patterns.
LETTERS = "[A-Z]{2,3}"
LETTERS_OR_DIGIT_LETTER = r"[A-Z]{2,3}|\d[A-Z]"

# Rejection reasons, as they appear in the rejection table.
INVALID_DATE_RANGE = "INVALID_DATE_RANGE"
DATE_NULL = "FlightDate NULL"
NUMBER_NULL = "FlightNumber NULL"
BOTH_NULL = "FlightNumber NULL-FlightDate NULL"
NUMBER_EMPTY = "FlightNumber EMPTY"
PURELY_NUMERIC = "FlightNumber PURELY_NUMERIC"
TOO_LONG = "FlightNumber TOO_LONG"
ALL_ZEROS = "FlightNumber ALL_ZEROS"
ALL_ALPHA = "FlightNumber ALL_ALPHA_AFTER_STRIP"
BAD_FORMAT = "FlightNumber BAD_FORMAT"
NO_VALID_SEGMENTS = "NO VALID SEGMENTS"
BATCH_DUPLICATE = "BATCH DUPLICATE"
TARGET_CONFLICT = "DB UNIQUE VIOLATION"


def _upper_compact(c: Column | str) -> Column:
    return F.replace(F.trim(F.upper(as_column(c))), F.lit(" "), F.lit(""))


def _strip_zeros(c: Column, carrier: str) -> Column:
    return F.regexp_replace(c, f"^({carrier})0+([1-9][0-9]*)$", "$1$2")


def normalize_flight(c: Column | str, carrier: str = LETTERS) -> Column:
    """Upper-case, drop spaces, drop the zeros between carrier and number; empty becomes null."""
    return F.nullif(_strip_zeros(_upper_compact(c), carrier), F.lit(""))


def normalize_flight_alnum(c: Column | str, carrier: str = LETTERS) -> Column:
    """As :func:`normalize_flight` after deleting everything but letters and digits."""
    bare = F.regexp_replace(F.upper(as_column(c)), "[^A-Z0-9]", "")
    return F.nullif(_strip_zeros(bare, carrier), F.lit(""))


def extract_flight(c: Column | str) -> Column:
    """The leading carrier-plus-number part, or null."""
    return F.nullif(F.regexp_extract(_upper_compact(c), f"^({LETTERS}[0-9]+)", 1), F.lit(""))


def normalize_flight_keep_digit(c: Column | str, inner_spaces: bool = False) -> Column:
    """Drop leading zeros but keep at least one digit; anything else is only trimmed and upper-cased."""
    text = F.trim(F.upper(as_column(c)))
    if inner_spaces:
        # only the first run of spaces can lie between carrier and number
        compact = F.when(text.rlike(rf"^{LETTERS}\s*[0-9]+$"), F.regexp_replace(text, r"\s+", "")).otherwise(text)
    else:
        compact = text
    return F.regexp_replace(compact, ZEROS_AFTER_CARRIER, "$1$2")


def normalize_flight_integer(c: Column | str) -> Column:
    """Carrier plus the number read as an integer (``000`` becomes ``0``); other text unchanged."""
    return F.regexp_replace(F.upper(strip_all(c)), f"^({LETTERS})0*([0-9]+)$", "$1$2")


def normalize_flight_hyphen(c: Column | str, allow_space: bool = False) -> Column:
    """``XX-0062`` (or ``XX 0062``) to ``XX62``; null tokens to null; other text as it is."""
    text = null_tokens(c, NULL_TOKENS)
    gap = r"[-\s]?" if allow_space else "-?"
    pattern = rf"^([A-Z0-9]{{2,3}}){gap}0*(\d+)$"
    return F.when(F.upper(text).rlike(pattern), F.regexp_replace(F.upper(text), pattern, "$1$2")).otherwise(text)


def first_flight_of_pair(c: Column | str) -> Column:
    """Text before the first slash without spaces."""
    first = strip_all(F.split_part(null_tokens(c), F.lit("/"), F.lit(1)))
    return F.nullif(F.replace(first, F.lit(" "), F.lit("")), F.lit(""))


def strip_prefix_zeros(c: Column | str) -> Column:
    """Drop all zeros after the carrier, even when nothing is left of the number."""
    return F.regexp_replace(F.upper(as_column(c)), f"^({LETTERS})0*", "$1")


# Made-up numbers by rule, and the zeros between carrier and number.
PLACEHOLDERS = {"carrier_zeros": f"^{LETTERS}0+$", "letters_only": "^[A-Z]{1,2}$"}
ZEROS_AFTER_CARRIER = f"^({LETTERS})0+([0-9]+)$"


def is_placeholder_flight(c: Column | str, rule: str = "carrier_zeros") -> Column:
    """True for made-up numbers. Rules: ``carrier_zeros``, ``ends_000``, ``letters_only``; null is false."""
    text = F.trim(F.upper(as_column(c)))
    tests = {
        "carrier_zeros": lambda: text.rlike(PLACEHOLDERS["carrier_zeros"]),
        "ends_000": lambda: text.endswith("000"),
        "letters_only": lambda: text.rlike(PLACEHOLDERS["letters_only"]),
    }
    return F.coalesce(tests[rule](), F.lit(False))


@dataclass(frozen=True)
class FlightRules:
    """Which checks apply to a normalised flight number."""

    max_length: int | None = 8
    reject_numeric: bool = True
    numeric_max_length: int | None = None
    full_format: bool = True
    join_null_reasons: bool = False


# The rule sets in use.
STRICT = FlightRules()
STRICT_JOINED = FlightRules(join_null_reasons=True)
MINIMAL = FlightRules(max_length=None, reject_numeric=False, full_format=False)
MINIMAL_NO_NUMERIC = FlightRules(max_length=None, full_format=False)
DIGITS_ALLOWED = FlightRules(max_length=10, reject_numeric=False, numeric_max_length=8)


def flight_reject_reason(fn: Column | str, dt: Column | str, rules: FlightRules = STRICT) -> Column:
    """First failing check of a slot, or null when the slot is valid.

    ``fn`` is a normalised number; pass a column rather than an expression, as the checks read it many times.
    """
    number, date = as_column(fn), as_column(dt)
    text = F.trim(number)
    numeric = text.rlike("^[0-9]+$")
    stripped = F.rtrim(text, F.lit("0"))
    checks: list[tuple[Column, str]] = [
        (number.isNull() & date.isNull(), BOTH_NULL if rules.join_null_reasons else NUMBER_NULL),
        (number.isNull(), NUMBER_NULL),
        (date.isNull(), DATE_NULL),
        (text == "", NUMBER_EMPTY),
    ]
    if rules.reject_numeric:
        checks.append((numeric, PURELY_NUMERIC))
    elif rules.numeric_max_length is not None:
        checks.append((numeric & (F.length(text) > rules.numeric_max_length), PURELY_NUMERIC))
    if rules.max_length is not None:
        checks.append((F.length(text) > rules.max_length, TOO_LONG))
    checks.append((stripped == "", ALL_ZEROS))
    checks.append((stripped.rlike(r"^\p{L}+$"), ALL_ALPHA))
    if rules.full_format:
        bad = ~F.upper(text).rlike(r"^[A-Z0-9]{2,3}[0-9]+$")
        checks.append((bad if rules.reject_numeric else bad & ~numeric, BAD_FORMAT))
    chain = F.when(*_case(checks[0]))
    for check in checks[1:]:
        chain = chain.when(*_case(check))
    return chain


def _case(check: tuple[Column, str]) -> tuple[Column, Column]:
    return check[0], F.lit(check[1])


def flight_reject_detail(fn: Column | str, reason: Column | str, dt: Column | str | None = None) -> Column:
    """Human-readable detail that goes with a reason; with the date given, a slot without either says so."""
    number, why = as_column(fn), as_column(reason)
    neither = (why == NUMBER_NULL) & as_column(dt).isNull() if dt is not None else F.lit(False)
    shown = F.coalesce(F.concat(F.lit("fn='"), strip_all(number), F.lit("'")), F.lit("fn=None"))
    upper = F.concat(F.lit("fn='"), F.upper(strip_all(number)), F.lit("'"))
    return (
        F.when((why == BOTH_NULL) | neither, F.lit("fn=None, dt=NaT"))
        .when(why == NUMBER_NULL, F.lit("fn=None"))
        .when(why == DATE_NULL, F.lit("dt=NaT"))
        .when(why == TOO_LONG, F.concat(shown, F.lit(" len="), F.length(strip_all(number)).cast("string")))
        .when(why == BAD_FORMAT, upper)
        .when(why.isNotNull(), shown)
    )


def is_valid_flight(fn: Column | str, dt: Column | str, rules: FlightRules = STRICT) -> Column:
    return flight_reject_reason(fn, dt, rules).isNull()


def carrier_of(fn: Column | str) -> Column:
    """Two-character carrier code, or the empty string."""
    return F.coalesce(F.regexp_extract(F.upper(as_column(fn)), "^([A-Z0-9]{2})", 1), F.lit(""))
