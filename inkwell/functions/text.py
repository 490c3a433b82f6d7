"""Column expressions for text handling (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's ``str.strip()`` removes.  Java's
# ``\s`` and Spark's ``trim`` miss most of them (U+3000 among others), so
# the class is spelled out.  The same class is valid RE2 syntax, which lets
# the DuckDB oracle use the identical pattern.
PY_SPACE = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set as a plain string, for ``btrim`` (a character-set trim: no
# regex per value, about 3x cheaper than the anchored pattern).
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                  + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")

# The label rule removes these literals, in this order.
LABEL_SUFFIXES = [".txt", ".md", "_raw"]
LABEL_PREFIXES = ["dialogue_log_", "essence_"]
LABEL_STAMP = r"[0-9]{8}(_[0-9]{6})?"
LABEL_EMPTY = "TOPIC"

# Fixed value: sentence ends used by the style rules.
SENTENCE_END = "[。！？!?.\n]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Strip leading/trailing whitespace the way Python ``str.strip()`` does."""
    return F.btrim(_c(c), F.lit(PY_SPACE_CHARS))


def squeeze_newlines(c) -> Column:
    """Collapse runs of three or more newlines into one blank line."""
    return F.regexp_replace(_c(c), r"\n{3,}", "\n\n")


def strip_quotes(c) -> Column:
    """Remove wrapping single/double quotes from a user-given path."""
    return F.regexp_replace(_c(c), "^['\"]+|['\"]+$", "")


def source_label(name) -> Column:
    """Topic label of a file name.

    lower → drop the suffix literals → drop the prefix literals → drop
    ``YYYYMMDD`` / ``YYYYMMDD_HHMMSS`` stamps (ASCII digits) → squeeze ``_`` →
    strip ``_`` → upper; an empty result becomes ``TOPIC``.
    """
    s = F.lower(_c(name))
    for lit in LABEL_SUFFIXES + LABEL_PREFIXES:
        s = F.replace(s, F.lit(lit), F.lit(""))
    s = F.regexp_replace(s, LABEL_STAMP, "")
    s = F.regexp_replace(s, "_+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    s = F.upper(s)
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(LABEL_EMPTY))


def split_sentences(c, pattern: str = SENTENCE_END) -> Column:
    """Array of stripped, non-empty sentences of a text."""
    parts = F.split(_c(c), pattern)
    stripped = F.transform(parts, lambda x: ustrip(x))
    return F.filter(stripped, lambda x: F.length(x) > 0)


def quote_literal(s: str) -> str:
    """A Java regex matching ``s`` literally (``Pattern.quote``)."""
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def count_literal(text, phrase: str) -> Column:
    """Non-overlapping occurrences of a literal phrase (``str.count``).

    ``regexp_count`` on a quoted literal scans once without building a
    replaced copy of the text (measured ~1.5x faster than length-replace).
    """
    return F.regexp_count(_c(text), F.lit(quote_literal(phrase))).cast("long")


def epoch_micros(c, dtype=None) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP or TIMESTAMP_NTZ column.

    NTZ values (what parquet files without a zone give) are measured as wall
    clock, independent of the session time zone; TIMESTAMP values as
    instants."""
    from pyspark.sql import types as T
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(c))
    return F.unix_micros(_c(c).cast("timestamp"))
