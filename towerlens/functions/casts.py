"""Lenient casts for external text.

Spark 4 runs in ANSI mode, where ``cast('abc' AS INT)`` fails the whole job.
External text must never fail a batch, so every cast of it is a ``try_cast``:
bad text becomes NULL. Text that is an integer is cast as one, so that all
digits of a BIGINT survive; other text goes through DOUBLE, so that ``'12.5'``
becomes 12 (truncation, as the legacy cast did). Out of range becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"}

# The characters Python's str.strip() removes: every code point with
# str.isspace() (all of them lie below U+3001).
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def python_strip(c: str | Column) -> Column:
    """Trim the same whitespace set as Python's ``str.strip()``."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def lenient_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def lenient_int(c: str | Column, target: str = "int") -> Column:
    return F.coalesce(_col(c).try_cast(target), _col(c).try_cast("double").try_cast(target))


def lenient_cast(c: str | Column, target: str) -> Column:
    """try_cast; text→integral by ``lenient_int`` (see module doc)."""
    t = target.lower()
    if t in _INTEGRAL:
        return lenient_int(c, t)
    return _col(c).try_cast(t)
