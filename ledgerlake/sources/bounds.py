"""A bound on modification times kept as text that the source itself can apply.

A typed comparison of text times cannot run in the source: it does not parse
them as Spark does.  ``certainly_older`` is SQL text that it can run.  It is true only for texts that
Spark is sure to read as a time before the watermark, so ``NOT`` of it keeps a
superset of what the typed filter takes, and the typed filter stays on top:

* every digit is turned into ``0``, and what is left must be one of the listed forms
  (date, or date and time with a space or ``T``, no fraction or one of three or six digits,
  no offset, ``Z`` or ``+hh:mm``);
* each field is in its range (days beyond the 28th by month, the 29th of February never
  counts), so Spark parses the text;
* an offset is within 18 hours, so the instant is at most 18 hours after the
  clock time written; and the date written lies before the date of (watermark - 18 hours).
  Hence instant < end of that date + 18 hours <= watermark.

Anything else (unpadded fields, other fractions, five-digit years, blanks in front, no time at
all, NULL) is left to the typed filter.  Only equal-length prefixes made of digits and
dashes in the same places are compared, so the source's collation does not matter.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from ledgerlake.functions.instants import from_micros, to_micros

#: The largest offset from UTC that a time may have.
LARGEST_OFFSET = dt.timedelta(hours=18)

_CLOCKS = [f"{sep}00:00:00{fraction}" for sep in (" ", "T") for fraction in ("", ".000", ".000000")]


def _any(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def certainly_older(column: str, watermark: dt.datetime | str, substring: str = "SUBSTRING") -> str:
    """SQL condition on a text column: true only for texts that are times before ``watermark``; NULL for NULL.

    ``substring`` is the source's name of the function (``SUBSTR`` for some).
    """
    day = (from_micros(to_micros(watermark)) - LARGEST_OFFSET).date().isoformat()

    def part(at: int, size: int) -> str:
        return f"{substring}({column}, {at}, {size})"

    shape = reduce(lambda text, digit: f"REPLACE({text}, '{digit}', '0')", "123456789", column)
    month, date = part(6, 2), part(9, 2)
    valid_date = (
        f"{month} >= '01' AND {month} <= '12' AND {date} >= '01' AND ({date} <= '28' OR ({date} <= '30' AND {month} <> '02') "
        f"OR ({date} = '31' AND {_any(month, ['01', '03', '05', '07', '08', '10', '12'])}))"
    )
    valid_clock = f"{part(12, 2)} <= '23' AND {part(15, 2)} <= '59' AND {part(18, 2)} <= '59'"
    forms = [_any(shape, ["0000-00-00"])]
    forms.append(f"({_any(shape, ['0000-00-00' + c + z for c in _CLOCKS for z in ('', 'Z')])} AND {valid_clock})")
    for size in (0, 4, 7):  # of a fraction with its point
        zoned = [f"0000-00-00{c}{sign}00:00" for c in _CLOCKS if len(c) == 9 + size for sign in "+-"]
        offset = f"{part(21 + size, 2)} <= '17' AND {part(24 + size, 2)} <= '59'"
        forms.append(f"({_any(shape, zoned)} AND {valid_clock} AND {offset})")
    first = part(1, 10)
    return f"({first} >= '0001-01-01' AND {first} < '{day}' AND {valid_date} AND ({' OR '.join(forms)}))"


def bounded_select(table: str, column: str, watermark: dt.datetime | str, substring: str = "SUBSTRING", columns: str = "*") -> str:
    """A query of ``table`` that leaves out rows whose time is certainly before ``watermark``."""
    return f"SELECT {columns} FROM {table} WHERE {column} IS NULL OR NOT {certainly_older(column, watermark, substring)}"
