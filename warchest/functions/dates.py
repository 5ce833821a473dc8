"""Date strings of the bulk files: ``MMDDYYYY``, ``MDDYYYY`` and ``MM/DD/YYYY``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_int, bind, strip

ColumnOrName = Column | str


def _text(c: ColumnOrName) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return strip(c.cast("string"))


def transaction_year(date: ColumnOrName) -> Column:
    """Four-digit year, without a range check.  A slashed text that is not ``a/b/YYYY`` is
    still tried by its length."""
    d = _text(date)
    return (
        F.when(d.rlike(r"\A[^/]*/[^/]*/[^/]{4}\z"), as_int(F.right(d, F.lit(4))))
        .when(F.length(d) == 8, as_int(F.substring(d, 5, 4)))
        .when(F.length(d) == 7, as_int(F.substring(d, 4, 4)))
    )


def transaction_month(date: ColumnOrName) -> Column:
    d = _text(date)
    return (
        F.when(d.rlike(r"\A[^/]{1,2}/[^/]*/[^/]*\z"), as_int(F.split_part(d, F.lit("/"), F.lit(1))))
        .when(F.length(d) == 8, as_int(F.substring(d, 1, 2)))
        .when(F.length(d) == 7, as_int(F.substring(d, 1, 1)))
    )


def iso_date(date: ColumnOrName, keep_iso: bool = False) -> Column:
    """``YYYY-MM-DD`` text.  Month, day and year ranges are checked, the calendar is not:
    ``02/31/2024`` passes.  ``keep_iso`` lets finished values through, so a second run over a
    converted column changes nothing."""
    def from_parts(parts: Column) -> Column:
        month, day, year = (F.get(parts, F.lit(i)) for i in range(3))
        valid = (
            (F.size(parts) == 3)
            & month.between(1, 12)
            & day.between(1, 31)
            & year.between(1900, 2100)
        )
        return F.when(valid, F.format_string("%04d-%02d-%02d", year, month, day))

    # Seven or eight characters without a slash are cut into the same three parts.
    slashed = F.regexp_replace(_text(date), r"\A([^/]{1,2})([^/]{2})([^/]{4})\z", "$1/$2/$3")
    out = bind(F.transform(F.split(slashed, "/"), as_int), from_parts)
    return F.when(slashed.rlike(_FINISHED), slashed).otherwise(out) if keep_iso else out


_FINISHED = r"\A(19[0-9]{2}|20[0-9]{2}|2100)-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])\z"


def calendar_date(date: ColumnOrName) -> Column:
    """Strict twin of :func:`iso_date`: a DATE, NULL when the day does not exist."""
    return F.try_to_date(iso_date(date, keep_iso=True), "yyyy-MM-dd")
