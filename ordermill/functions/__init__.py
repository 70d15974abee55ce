"""Column-level helpers (all built-in expressions, no Python UDFs)."""

from ordermill.functions.text import (  # noqa: F401
    blank,
    iso_text,
    parse_int,
    parse_ts,
    strip_space,
    strip_unicode,
    text_or_none,
)
from ordermill.functions.json import raw_row_json, to_envelope_value  # noqa: F401
from ordermill.functions.money import cents_to_amount  # noqa: F401
