"""Cleaning expressions: tolerant parsing, null handling, text clean-up.

Every function returns a ``Column`` built from built-in Spark SQL functions so
it stays inside whole-stage codegen.  ANSI mode is on, so every parse goes
through a ``try_*`` form (SURVEY D2, D3, D5).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P18 / D2 --------------------------------------------------------------------
_INFINITE = r"(?i)^[+-]?inf(inity)?$"
# Digits with an optional fraction and exponent; suffixes and hexadecimal forms of the JVM's parser are no numbers.
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# A written exponent above 308 leaves the range of a double, whatever stands before it.
_EXPONENT_TOO_LARGE = r"[eE]\+?0*(309|3[1-9]\d|[4-9]\d\d|[1-9]\d{3,})$"


def to_number(c: ColumnOrName) -> Column:
    """Tolerant numeric parse: text → double, unparsable → NULL, NaN → NULL.

    Surrounding blanks are accepted (``' 12 '`` → 12.0); ``'1,234'`` and ``'abc'``
    become NULL, like a coercing parse.  Text beyond the range of a double is not a
    number (``'1e400'``, ``'0e400'``), text too close to zero is zero (``'1e-400'``);
    only an explicit ``'inf'`` is infinite.
    """
    t = F.trim(_c(c).cast("string"))
    d = _try_cast(t, "double")
    finite = t.rlike(_DECIMAL) & ~t.rlike(_EXPONENT_TOO_LARGE) & (F.abs(d) < float("inf"))
    return F.when(finite | t.rlike(_INFINITE), d)


def _try_cast(c: Column, type_: str) -> Column:
    return c.try_cast(type_)


def to_long(c: ColumnOrName) -> Column:
    """Tolerant integer parse: number text (possibly with a fraction) → bigint truncated."""
    return trunc_to_long(to_number(c))


# P16 / D5 --------------------------------------------------------------------
def trunc_to_long(c: ColumnOrName) -> Column:
    """``astype(int)``: truncate toward zero; NULL/NaN/inf/out of range → NULL."""
    x = _c(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x.try_cast("bigint")).cast("bigint")


# P19 -------------------------------------------------------------------------
def code_to_text(c: ColumnOrName) -> Column:
    """Categorical code normalise: number → integer → string (``12.0`` → ``'12'``)."""
    x = _c(c)
    n = to_number(x)
    return F.coalesce(trunc_to_long(n).cast("string"), F.trim(x.cast("string")))


# F10 / D3 --------------------------------------------------------------------
# Layouts tried when no format is given (a coercing parse without a format infers
# these; slashed day-month order follows its month-first default).
DEFAULT_DATE_PATTERNS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "yyyy.MM.dd", "yyyy-MM-dd HH:mm:ss",
                         "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS",
                         "MM/dd/yyyy")


def to_date_tolerant(c: ColumnOrName, patterns: Iterable[str] | str | None = None) -> Column:
    """Date parse that never raises: first pattern that parses wins, else NULL.

    Date/timestamp input is passed through (cast to date); only text is parsed.
    """
    x = _c(c)
    if isinstance(patterns, str):
        patterns = (patterns,)
    pats = tuple(patterns or DEFAULT_DATE_PATTERNS)
    s = F.trim(x.cast("string"))
    return F.coalesce(*[_parse_one(s, p) for p in pats])


# yyyy<sep>MM<sep>dd patterns accept one- or two-digit month and day (as strptime's
# %m/%d do) but nothing longer: a lenient pattern behind a shape check.
_YMD = {"yyyy-MM-dd": ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
        "yyyy/MM/dd": ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
        "yyyy.MM.dd": ("yyyy.M.d", r"^\d{4}\.\d{1,2}\.\d{1,2}$")}


def _parse_one(s: Column, pattern: str) -> Column:
    if pattern in _YMD:
        lenient, shape = _YMD[pattern]
        return F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(lenient)).cast("date"))
    return F.try_to_timestamp(s, F.lit(pattern)).cast("date")


def date_column(df, name: str, patterns: Iterable[str] | str | None = None) -> Column:
    """Schema-aware date: a stored date is used as is (so range predicates on it
    reach the scan as pushed filters), a timestamp is truncated, text is parsed
    tolerantly."""
    from pyspark.sql.types import DateType, TimestampNTZType, TimestampType
    t = df.schema[name].dataType
    if isinstance(t, DateType):
        return F.col(name)
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.col(name).cast("date")
    return to_date_tolerant(F.col(name), patterns)


# Dates of feeds ----------------------------------------------------------
# Weekday and time zone as feeds write them; the weekday only repeats the date, so it is cut off.
_WEEKDAY = r"^\s*[A-Za-z]{3,9}\.?,\s*"
FEED_DATE_PATTERNS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z",
                      "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss")


def feed_timestamp(c: ColumnOrName) -> Column:
    """A feed's publication date (``Mon, 01 Jan 2024 09:00:00 +0900``) as a point in time; what is none becomes NULL."""
    s = F.trim(F.regexp_replace(F.trim(_c(c)), _WEEKDAY, ""))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in FEED_DATE_PATTERNS])


# P9 / P10 / P11 --------------------------------------------------------------
def not_null_flag(c: ColumnOrName) -> Column:
    """``notnull().astype(int)``."""
    return _c(c).isNotNull().cast("int")


def non_empty(c: ColumnOrName) -> Column:
    """F8: value is present and not the empty string (Python truthiness of text)."""
    x = _c(c)
    return x.isNotNull() & (x != F.lit(""))


# P13 / D4 --------------------------------------------------------------------
def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division with x/0 → NULL (documented replacement for pandas ±inf / NaN)."""
    return F.try_divide(_c(a), _c(b))


# P5 --------------------------------------------------------------------------
def contains_text(c: ColumnOrName, needle: str, regex: bool = False) -> Column:
    """``.str.contains(s, na=False)``: NULL text → false."""
    x = _c(c)
    m = x.rlike(needle) if regex else x.contains(needle)
    return F.coalesce(m, F.lit(False))


# F7 --------------------------------------------------------------------------
def money_text_to_long(c: ColumnOrName) -> Column:
    """Money text → integer: drop thousands commas, cut at the first '.', parse.

    ``'1,234,567.8'`` → 1234567; ``'abc'`` → NULL (the row is skipped by callers).
    """
    x = F.replace(_c(c), F.lit(","), F.lit(""))
    head = F.split_part(x, F.lit("."), F.lit(1))
    return _try_cast(head, "bigint")


# F1 / F2 / U2 ----------------------------------------------------------------
# The four entities decoded by the news cleaner, in this order.
HTML_ENTITIES_IN_ORDER = (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
# A tag never spans a line break: '.' in the source pattern does not match '\n'.
TAG_PATTERN = "<[^\n]*?>"


def strip_tags(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), TAG_PATTERN, "")


def decode_entities(c: ColumnOrName) -> Column:
    x = _c(c)
    for ent, ch in HTML_ENTITIES_IN_ORDER:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def clean_html(c: ColumnOrName) -> Column:
    """Strip tags, then decode the four entities (``&amp;lt;`` → ``&lt;``)."""
    return decode_entities(strip_tags(c))


def xml_escape(c: ColumnOrName) -> Column:
    """Escape text for an XML element body (inverse of the parser's decoding)."""
    x = F.replace(_c(c), F.lit("&"), F.lit("&amp;"))
    x = F.replace(x, F.lit("<"), F.lit("&lt;"))
    return F.replace(x, F.lit(">"), F.lit("&gt;"))


# F3 / F4 / F5 / F6 -----------------------------------------------------------
def strip_digits(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), r"\d+", "")


def file_stem(c: ColumnOrName) -> Column:
    """Base name without directory and without the last extension."""
    base = F.regexp_replace(_c(c), r"^.*[/\\]", "")
    return F.regexp_replace(base, r"\.[^.]*$", "")


def has_extension(c: ColumnOrName, exts: Iterable[str]) -> Column:
    low = F.lower(_c(c))
    cond = F.lit(False)
    for e in exts:
        cond = cond | low.endswith(e.lower())
    return cond


# F9 / D17 --------------------------------------------------------------------
def url_quote(c: ColumnOrName) -> Column:
    """Percent-encode exactly like Python's ``urllib.parse.quote`` (safe='/').

    Spark's encoder writes space as '+', keeps '*', encodes '~' and '/'.  Each
    of those outputs has a single source character (a literal '+' or '%' is
    itself encoded), so literal replacements give the same text.
    """
    x = F.url_encode(_c(c))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def remove_spaces(c: ColumnOrName) -> Column:
    return F.replace(_c(c), F.lit(" "), F.lit(""))


# NaN → NULL at the scan (D7) ------------------------------------------------
def nan_to_null(c: ColumnOrName) -> Column:
    x = _c(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


# Rounding used for value comparison ------------------------------------------
SIG_DIGITS = 9


def sig_sql(expr: str, digits: int = SIG_DIGITS) -> str:
    """SQL text rounding ``expr`` to ``digits`` significant digits.

    The same text runs in Spark SQL and DuckDB and uses only exact powers of
    ten, so both engines produce the same double from the same input.
    """
    expr = f"({expr})"
    s = f"({digits} - CAST(ceil(log10(abs({expr}))) AS INT))"
    return (f"(CASE WHEN {expr} IS NULL OR {expr} = 0 OR isnan({expr}) OR abs({expr}) > 1e300 "
            f"THEN {expr} "
            f"WHEN {s} >= 0 THEN round({expr} * pow(10, {s})) / pow(10, {s}) "
            f"ELSE round({expr} / pow(10, -{s})) * pow(10, -{s}) END)")


def round_sig(col_name: str, digits: int = SIG_DIGITS) -> Column:
    """Column rounded to ``digits`` significant digits (see ``sig_sql``)."""
    return F.expr(sig_sql(f"`{col_name}`", digits))
