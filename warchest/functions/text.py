"""Small text helpers shared by the column-expression libraries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character counted as white space.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a pattern, in ranges.
OTHER_WS = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = f"[ {OTHER_WS}]"


def squeeze(c: Column) -> Column:
    """Every run of white space becomes one blank.  The look-ahead keeps ordinary characters
    cheap, and single blanks are not rewritten."""
    return F.regexp_replace(c, f"(?=[^!-~])(?: {WS}+|[{OTHER_WS}]{WS}*)", " ")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def as_int(c: Column) -> Column:
    """Integer in ``c``, or NULL; a single ``_`` between digits is allowed."""
    return F.regexp_replace(c, "(?<=[0-9])_(?=[0-9])", "").try_cast("int")


def before_comma(c: Column) -> Column:
    return F.substring_index(c, ",", 1)


def after_comma(c: Column) -> Column:
    return F.substr(c, F.instr(c, ",") + 1)


def words(c: Column) -> Column:
    """White-space separated words of a stripped text.  Splitting on one plain character needs
    no pattern per row."""
    return F.split(squeeze(c), " ")


def lookup(table: dict[str, str], c: Column) -> Column:
    """Value for ``c`` in a small fixed table, NULL when it has none."""
    quoted = ["'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for pair in table.items() for x in pair]
    return F.element_at(F.expr(f"map({', '.join(quoted)})"), c)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
