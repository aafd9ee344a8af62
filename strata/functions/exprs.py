"""Column -> Column helpers. Every helper is built from native Spark functions,
so it stays inside whole-stage code generation; none of them runs Python per row.

ANSI mode is on by default in Spark 4, so every lenient conversion of the
surveyed workload is a ``try_*`` function here: a bad value becomes NULL
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of",
    "try_int",
    "try_decimal_or_zero",
    "try_int_or_zero",
    "to_text",
    "to_text_truncated",
    "lenient_timestamp",
    "strip_leading_zeros",
    "is_blank",
    "sanitise_name",
    "extract_year",
    "year_month_key",
    "safe_ratio",
    "string_size_bucket",
    "resolve_relative_url",
    "ends_with_suffix",
    "like_to_regex",
    "FORBIDDEN_NAME_CHARS",
]

# Fixed values that must equal the surveyed workload:
# characters deleted from file/table names
FORBIDDEN_NAME_CHARS = '\\/*?:"<>|'
# year pattern searched in resource titles
YEAR_PATTERN = r"\b(20\d{2})\b"
# fractional-seconds suffix stripped before parsing a timestamp
FRACTION_SUFFIX = r"\.\d+$"
DAY_FIRST = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})((?:[ T]\d{1,2}:\d{2}(?::\d{2})?)?)$"
# length of the truncated lookup keys (NVARCHAR(50))
LOOKUP_KEY_CHARS = 50


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c: str | Column) -> Column:
    """``TRY_CONVERT(INT, x)``; note: ``''`` is NULL here (0 in the source engine)."""
    return col_of(c).try_cast("int")


def try_int_or_zero(c: str | Column) -> Column:
    """``ISNULL(TRY_CONVERT(INT, x), 0)``."""
    return F.coalesce(try_int(c), F.lit(0))


def try_decimal_or_zero(c: str | Column, precision: int = 18, scale: int = 2) -> Column:
    """``ISNULL(TRY_CONVERT(DECIMAL(p,s), x), 0)``."""
    dtype = f"decimal({precision},{scale})"
    return F.coalesce(col_of(c).try_cast(dtype), F.lit(0).cast(dtype))


def to_text(c: str | Column) -> Column:
    """``CAST(x AS NVARCHAR(MAX))``."""
    return col_of(c).cast("string")


def to_text_truncated(c: str | Column, n: int = LOOKUP_KEY_CHARS) -> Column:
    """``CAST(x AS NVARCHAR(n))``: the first ``n`` characters."""
    return F.substring(to_text(c), 1, n)


def lenient_timestamp(c: str | Column) -> Column:
    """Drop a trailing ``.fraction`` and parse leniently (ISO, or day first with
    ``/`` or ``-``); NULL when unparsable.

    Returns ``timestamp_ntz``: the text is read as a wall-clock value directly,
    so no session time zone (and no daylight-saving gap) is involved.
    """
    cleaned = F.trim(F.regexp_replace(to_text(c), FRACTION_SUFFIX, ""))
    # day first: 31/12/2020 or 31-12-2020, with or without a time of day
    parts = F.regexp_extract(cleaned, DAY_FIRST, 0)
    iso = F.concat_ws(
        "-", F.regexp_extract(cleaned, DAY_FIRST, 3), F.lpad(F.regexp_extract(cleaned, DAY_FIRST, 2), 2, "0"),
        F.lpad(F.regexp_extract(cleaned, DAY_FIRST, 1), 2, "0"),
    )
    day_first = F.concat(iso, F.regexp_extract(cleaned, DAY_FIRST, 4))
    return F.when(parts != "", day_first).otherwise(cleaned).try_cast("timestamp_ntz")


def strip_leading_zeros(c: str | Column) -> Column:
    """Key normalisation: text, leading ``0`` removed (``'01'`` -> ``'1'``, ``'000'`` -> ``''``)."""
    return F.ltrim(to_text(c), F.lit("0"))


def is_blank(c: str | Column) -> Column:
    """``trim(x) = ''``; NULL stays NULL (three-valued)."""
    return F.trim(col_of(c)) == F.lit("")


def sanitise_name(c: str | Column) -> Column:
    """File/table name cleaning: lower, drop ``.csv``/``.zip``, spaces to ``_``,
    delete ``\\/*?:"<>|``, upper."""
    lowered = F.lower(to_text(c))
    no_ext = F.replace(F.replace(lowered, F.lit(".csv"), F.lit("")), F.lit(".zip"), F.lit(""))
    underscored = F.replace(no_ext, F.lit(" "), F.lit("_"))
    cleaned = F.regexp_replace(underscored, r'[\\/*?:"<>|]', "")
    return F.upper(cleaned)


def extract_year(c: str | Column) -> Column:
    """First stand-alone ``20xx`` in the text as INT, else NULL."""
    found = F.regexp_extract(to_text(c), YEAR_PATTERN, 1)
    return F.when(found == "", F.lit(None).cast("int")).otherwise(found.try_cast("int"))


def year_month_key(year: str | Column, month: str | Column) -> Column:
    """Intelligent date key ``YYYY*100 + MM`` from lenient integer parts; NULL when
    a part is unparsable or the key does not fit an INT."""
    return F.try_add(F.try_multiply(try_int(year), F.lit(100)), try_int(month))


def safe_ratio(num: Column, den: Column, precision: int = 18, scale: int = 6) -> Column:
    """``CASE WHEN den = 0 THEN 0 ELSE CAST(num AS DECIMAL(p,s)) / NULLIF(CAST(den AS DECIMAL(p,s)), 0) END``
    stored as ``DECIMAL(p,s)``; NULL when ``den`` is NULL.

    The operands are widened to 38 digits before dividing, so large sums do not
    overflow the ``DECIMAL(p,s)`` operand casts (the ratio itself is small).
    """
    wide = f"decimal(38,{scale})"
    dtype = f"decimal({precision},{scale})"
    quotient = num.cast(wide) / F.nullif(den.cast(wide), F.lit(0).cast(wide))
    return F.when(den == 0, F.lit(0).cast(dtype)).otherwise(quotient).cast(dtype)


def string_size_bucket(max_len: Column) -> Column:
    """Declared text size: ``ceil(len/100)*100``, 100 when empty or NULL."""
    bucket = (F.ceil(max_len / F.lit(100)) * F.lit(100)).cast("bigint")
    return F.when(max_len.isNull() | (max_len == 0), F.lit(100).cast("bigint")).otherwise(bucket)


def resolve_relative_url(href: str | Column, base_url: str | Column) -> Column:
    """A root-relative ``href`` (``/x``) is prefixed with scheme://host of ``base_url``."""
    root = F.regexp_extract(to_text(base_url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    h = to_text(href)
    return F.when(h.startswith("/"), F.concat(root, h)).otherwise(h)


def ends_with_suffix(c: str | Column, suffix: str, case_sensitive: bool = True) -> Column:
    text = to_text(c)
    if case_sensitive:
        return text.endswith(suffix)
    return F.lower(text).endswith(suffix.lower())


def like_to_regex(pattern: str) -> str:
    """Translate a SQL ``LIKE`` pattern (``%``, ``_``) into an anchored regex."""
    out = []
    for ch in pattern:
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        else:
            out.append("\\" + ch if ch in r".^$*+?{}[]\|()" else ch)
    return "^" + "".join(out) + "$"
