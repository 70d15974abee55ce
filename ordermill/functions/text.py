"""Text predicates and guarded conversions.

Spark's ``try_cast`` is more lenient than the upstream rules in places
('2026' parses as a timestamp, '8:15' becomes today's 08:15 under TIMESTAMP),
so conversions are guarded by a regular expression and only then cast.
The same regex guard is what an equivalent SQL query uses, so results agree
across engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms (ASCII digits; ISO date, optional time 00:00-23:59:59,
# optional fraction up to microseconds, years 0001-9999, no zone offset).
# Whitespace as Python's str.strip() removes it, as a character class for both engines' regular expressions.
WHITESPACE = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
ISO_TS_TEXT = r"^(000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})-[0-9]{2}-[0-9]{2}([T ]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,6})?)?)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c) -> Column:
    """Remove leading/trailing spaces (SQL TRIM)."""
    return F.trim(_c(c))


def strip_unicode(c) -> Column:
    """Remove leading/trailing whitespace of any kind (tabs, newlines, no-break and ideographic spaces too)."""
    return F.regexp_replace(_c(c), f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def blank(c, whitespace: str = "space") -> Column:
    """NULL, empty, or only whitespace. ``whitespace``: 'space' or 'any'."""
    stripped = strip_space(c) if whitespace == "space" else strip_unicode(c)
    return _c(c).isNull() | (stripped == F.lit(""))


def parse_int(c, bits: int = 64) -> Column:
    """Integer text (optional sign and surrounding spaces) -> BIGINT/INT, else NULL.

    Out-of-range values (e.g. above 2^31-1 for ``bits=32``) are NULL too.
    """
    target = "bigint" if bits == 64 else "int"
    c = _c(c)
    return F.when(c.rlike(INT_TEXT), F.trim(c).try_cast(target)).cast(target)


def parse_ts(c) -> Column:
    """ISO-8601 local date-time text -> TIMESTAMP_NTZ, else NULL.

    Zone offsets are rejected rather than silently dropped.
    """
    c = _c(c)
    return F.when(c.rlike(ISO_TS_TEXT), c.try_cast("timestamp_ntz")).cast("timestamp_ntz")


def iso_text(c, sep: str = "T") -> Column:
    """TIMESTAMP -> 'yyyy-MM-ddTHH:mm:ss' (``sep=' '`` gives the export form)."""
    return F.date_format(_c(c), f"yyyy-MM-dd'{sep}'HH:mm:ss")


def text_or_none(c) -> Column:
    """Render a value for a message; a missing value reads 'None'."""
    return F.coalesce(_c(c).cast("string"), F.lit("None"))
