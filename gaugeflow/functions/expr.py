"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow import schemas as S


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_away(col: Column | str, scale: int = 2) -> Column:
    """Round a double to ``scale`` places, halves away from zero, on the
    binary value scaled by 10**scale (P14).

    Spark's ``round`` rounds the decimal text of the double, which differs on
    ties such as 1.005; this form rounds ``x * 10**scale`` instead. NaN and
    infinities pass through unchanged, as do values so large that a double
    holds no further digit at that scale.
    """
    x = _c(col)
    factor = float(10 ** scale)
    whole = F.abs(x) * F.lit(factor) >= F.lit(float(2 ** 52))
    rounded = F.signum(x) * (F.floor(F.abs(x) * F.lit(factor) + F.lit(0.5)) / F.lit(factor))
    return F.when(F.isnan(x) | whole, x).otherwise(rounded)


def pct_of(value: Column | str, capacity: Column | str, scale: int = 2) -> Column:
    """Guarded fill percentage: NULL unless capacity > 0."""
    cap = _c(capacity)
    return F.when(cap > 0, round_half_away(F.lit(100.0) * _c(value) / cap, scale))


def rel_diff_pct(estimate: Column | str, reference: Column | str, scale: int | None = 2) -> Column:
    """Guarded relative difference in percent, ``(est - ref) / ref * 100``.

    ``scale=None`` keeps the unrounded value."""
    ref = _c(reference)
    raw = (_c(estimate) - ref) / ref * F.lit(100.0)
    return F.when(ref > 0, raw if scale is None else round_half_away(raw, scale))


# The characters that Python's str.strip() removes.
WHITESPACE = (" \t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# A number as SQL and CSV readers take it: no type suffix (12d), no hexadecimal.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity|nan)$"

# Characters of numbers that every reader takes alike.
PLAIN_NUMBERS = r"^[-+0-9. ]*+\z"


def strip_ws(col: Column | str) -> Column:
    r"""Strip leading and trailing whitespace of every kind; NULL stays NULL (P5).

    ``trim`` only removes spaces; ``btrim`` with the full set matches
    ``str.strip()`` without a regex."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def null_tokens(col: Column | str, tokens: list[str] | None = None) -> Column:
    """Map the NULL tokens of the gauge files to NULL (S3)."""
    c = _c(col)
    return F.when(c.isin(tokens if tokens is not None else S.NULL_TOKENS), F.lit(None)).otherwise(c)


def try_double(col: Column | str) -> Column:
    """Text -> double, anything unparseable -> NULL (P3, P9). Surrounding
    whitespace is ignored.

    The cast alone decides almost every cell. It takes more than numbers
    (suffixes, hexadecimal) only where one of their letters stands in the text;
    those cells, and cells it refuses, are checked by the pattern. Without a
    digit or an n (nan, inf) nothing is a number: a refused cast costs far more."""
    c = _c(col)
    value = c.try_cast("double")
    text = strip_ws(c)
    odd = value.isNull() | F.rlike(c, F.lit("[dDfFxX]"))
    read = F.when(odd, F.when(F.rlike(text, F.lit(NUMBER)), text.try_cast("double"))).otherwise(value)
    return F.when(F.rlike(c, F.lit("[0-9nN]")), read)


def try_doubles(texts: Column | str) -> Column:
    """:func:`try_double` of every element of an array. Of texts that hold only
    digits, points, signs and blanks the cast decides; it casts a whole array
    in compiled code, while a function of the elements is interpreted."""
    c = _c(texts)
    plain = F.rlike(F.concat_ws(" ", c), F.lit(PLAIN_NUMBERS))
    return F.when(plain, c.try_cast("array<double>")).otherwise(F.transform(c, try_double))


def try_int(col: Column | str, strict: bool = False) -> Column:
    """Text -> nullable int (P4). Whole numbers ("12", "12.0") convert;
    fractional values are NULL, or raise when ``strict``."""
    d = try_double(_c(col).cast("string"))
    whole = d == F.floor(d)
    fits = (d >= F.lit(-2147483648.0)) & (d <= F.lit(2147483647.0))
    good = F.when(whole & fits, d.cast("int"))
    if strict:
        return F.when(d.isNull() | (whole & fits), good).otherwise(
            F.raise_error(F.concat(F.lit("not an integer: "), _c(col).cast("string")))
        )
    return good


def right(col: Column | str, n: int) -> Column:
    """Last ``n`` characters."""
    return F.right(_c(col), F.lit(n))


def clean_dam_name(col: Column | str) -> Column:
    """Remove a trailing ", Abbrev." suffix from a name."""
    return F.regexp_replace(_c(col), S.DAM_NAME_SUFFIX_PATTERN, "")


def safe_label(col: Column | str) -> Column:
    """Partition label safe for file names: space and '/' become '_' (P16)."""
    return F.translate(_c(col), " /", "__")


def month_key(col: Column | str) -> Column:
    """``yyyy-MM`` month key of a date."""
    return F.date_format(_c(col), "yyyy-MM")


def normalize_header(name: str) -> str:
    """Collapse whitespace runs (line breaks included) and strip.
    Column names are metadata: this runs on the driver, no job."""
    return " ".join(name.split())
