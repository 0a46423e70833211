"""String predicates and normalisers over whole column values (JVM regex, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The "blank" set is every character up to and including U+0020, the set a JVM
# String.trim removes. Spark's own trim strips spaces only, so the set is spelt out.
_NOT_BLANK_CHAR = r"[^\x00-\x20]"
_EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+\z"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_blank(x: Column | str) -> Column:
    """True when the value is NULL or holds no character above U+0020 (whole text)."""
    x = _c(x)
    return x.isNull() | ~x.rlike(_NOT_BLANK_CHAR)


def trim_blanks(x: Column | str) -> Column:
    """Strip characters up to U+0020 from both ends (``\\z`` anchors at the very end)."""
    return F.regexp_replace(_c(x), _EDGE_BLANKS, "")


def normalise_text(x: Column | str) -> Column:
    """Trim as above, then upper-case."""
    return F.upper(trim_blanks(x))


def escape_breaks(x: Column | str) -> Column:
    """Text on one line: ``\\`` for a backslash, ``\n`` and ``\r`` for line breaks."""
    x = F.col(x) if isinstance(x, str) else x
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        x = F.replace(x, F.lit(plain), F.lit(escaped))
    return x


def unescape_breaks(x: Column | str) -> Column:
    """What ``escape_breaks`` was given. Pairs of backslashes are taken first, from the left."""
    x = F.col(x) if isinstance(x, str) else x

    def breaks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    return F.array_join(F.transform(F.split(x, r"\\\\", -1), breaks), "\\")
