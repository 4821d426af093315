"""Column-expression builders for the cleaning rules.

Everything here returns a ``Column`` made of built-in Spark functions, so the rules run
inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results: the tokens removed
# from organisation names, applied one after the other, in this order, anywhere in the text.
ORG_NAME_TOKENS: tuple[str, ...] = (
    "&QUOT;", '"', "'", "/", ".", ",", "(", ")",
    " INC", " CORPORATION", " CORP", " LLC", " LIMITED", " LTD", " LP", " PC",
)

# Characters removed by Python's ``str.strip()`` from ASCII text.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove ASCII whitespace at both ends (``trim`` alone removes blanks only)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def remove_all(col: Column | str, tokens: Sequence[str]) -> Column:
    """Remove every token, one after the other, in the given order.

    Sequential removal is not one regex: removing a token can join text into a new match
    of a later token, and the rules depend on that.
    """
    out = _c(col)
    for tok in tokens:
        out = F.replace(out, F.lit(tok), F.lit(""))
    return out


def normalize_org_name(col: Column | str, upper: bool = False, tokens: Sequence[str] = ORG_NAME_TOKENS,
                       whole_word: bool = False) -> Column:
    """Optionally upper-case, remove punctuation and legal suffixes, strip.

    By default a suffix token is removed anywhere, also inside a word (' INCORPORATED' loses
    ' INC'), as the reference does.  ``whole_word=True`` removes a suffix token (one starting
    with a blank) only where no letter or digit follows it; punctuation is removed as usual.
    """
    c = _c(col)
    if upper:
        c = F.upper(c)
    if not whole_word:
        return strip(remove_all(c, tokens))
    for tok in tokens:
        if tok.startswith(" "):
            c = F.regexp_replace(c, re.escape(tok) + r"(?![A-Za-z0-9])", "")
        else:
            c = F.replace(c, F.lit(tok), F.lit(""))
    return strip(c)


def is_all_digits(col: Column | str) -> Column:
    """``str.isdigit()`` for ASCII digits: non-empty and digits only (false for '')."""
    return _c(col).rlike(r"\A[0-9]+\z")


def starts_with_digit(col: Column | str) -> Column:
    """``s[0].isdigit()`` with '' counted as not starting with a digit."""
    return _c(col).rlike(r"\A[0-9]")


def is_blank(col: Column | str) -> Column:
    """Null or empty string."""
    c = _c(col)
    return c.isNull() | (c == F.lit(""))


_NUMBER_RE = r"\A\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*\z"
_DATE_RE = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def safe_double(col: Column | str) -> Column:
    """SAFE_CAST(x AS FLOAT64) over decimal numbers, with or without exponent; anything else is null."""
    c = _c(col).cast("string")
    return F.when(c.rlike(_NUMBER_RE), c.try_cast("double"))


def safe_bool(col: Column | str) -> Column:
    """SAFE_CAST(x AS BOOL): only the words true/false (any case); anything else is null."""
    lc = F.lower(strip(_c(col).cast("string")))
    return F.when(lc == "true", F.lit(True)).when(lc == "false", F.lit(False))


def safe_date(col: Column | str) -> Column:
    """SAFE_CAST(x AS DATE) for 'yyyy-m-d' text (optionally followed by a time); else null."""
    c = _c(col).cast("string")
    return F.when(c.rlike(_DATE_RE), c.try_cast("date"))


def parse_us_date(col: Column | str) -> Column:
    """'m/d/yyyy' (padded or not) to DATE; malformed text gives null."""
    return F.try_to_date(_c(col), "M/d/yyyy")


def number_without_commas(col: Column | str) -> Column:
    """Remove thousands separators, then a safe double cast."""
    return safe_double(F.replace(_c(col), F.lit(","), F.lit("")))


def yes_flag(col: Column | str) -> Column:
    """'Y' or 'Yes' is true, everything else (null included) is false."""
    return F.coalesce(_c(col).isin("Y", "Yes"), F.lit(False))


def round_half_up(col: Column | str, scale: int = 2) -> Column:
    """ROUND(x, scale) on a double, half away from zero on its decimal text.

    One rounding step on the number's shortest decimal text, for values of any size.
    """
    return F.round(_c(col).cast("double"), scale)


def year_boundaries_between(start: Column | str, end: Column | str) -> Column:
    """DATE_DIFF(end, start, YEAR): number of year boundaries crossed (bigint)."""
    return (F.year(_c(end)) - F.year(_c(start))).cast("bigint")


def rsplit_second(col: Column | str, sep: str = ",", maxsplit: int = 3) -> Column:
    """``s.rsplit(sep, maxsplit)[1]``; null when there is no second part.

    With ``n`` parts after a full split, the rsplit keeps the last ``maxsplit`` parts whole, so
    its element 1 is part ``max(n - maxsplit, 1)`` (0-based).
    """
    parts = F.split(_c(col), F.lit(sep), -1)
    return F.get(parts, F.greatest(F.size(parts) - F.lit(maxsplit), F.lit(1)))


def text_key(cols: Sequence[Column | str], types: dict[str, str] | None = None) -> Column:
    """Deterministic surrogate key: md5 over the given columns, different rows having different text.

    A value is written as its length, a colon and its text, null as ``N``.  A double is written as its
    six-decimal text and what is left of it beyond them, so that no two doubles share a text.
    """
    parts = []
    types = types or {}
    for col in cols:
        c = _c(col)
        text = c.cast("string")
        if isinstance(col, str) and types.get(col) == "double":
            rounded = c.try_cast("decimal(38,6)")
            rest = c - rounded.cast("double") + F.lit(0.0)
            text = F.coalesce(F.concat(rounded.cast("string"), F.lit("~"), rest.cast("string")), text)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    return F.md5(F.concat(*parts))
