"""Size and message formatting (F1, F2, F4, A4's MB figure).

Rounding: the reference formats with Python, which rounds the exact binary
value half-to-even, while Spark's ``format_string`` rounds half-up. For sizes
(an integer divided by a power of 1024, an exact binary fraction) the two
differ only on exact ties, and ``bround`` (half-even) settles those first, so
the strings agree for every size below 2^53 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed unit ladder, base 1024.
UNITS = ("B", "KB", "MB", "GB", "TB", "PB")
MIB = 1024 * 1024


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _one_decimal(x: Column) -> Column:
    return F.format_string("%.1f", F.bround(x, 1))


def human_size(n) -> Column:
    """``'%.1f <unit>'`` with a space; the unit is chosen on ``abs(n)``.
    An unknown size has no text."""
    v = _c(n).cast("double")
    a = F.abs(v)
    expr = None
    for k, unit in enumerate(UNITS[:-1]):
        scaled = v / float(1024 ** k)
        cond = a < float(1024 ** (k + 1))
        text = F.concat(_one_decimal(scaled), F.lit(f" {unit}"))
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    text = expr.otherwise(F.concat(_one_decimal(v / float(1024 ** 5)), F.lit(" PB")))
    return F.when(v.isNotNull(), text)


def human_size_compact(n) -> Column:
    """bytes as a whole number (``512B``), larger units with one decimal
    and no space (``1.5KB``). No ``abs``: negative sizes stay in bytes."""
    raw = _c(n)
    v = raw.cast("double")
    expr = F.when(v < 1024.0, F.concat(raw.cast("bigint").cast("string"), F.lit("B")))
    for k, unit in enumerate(UNITS[1:-1], start=1):
        expr = expr.when(v < float(1024 ** (k + 1)), F.concat(_one_decimal(v / float(1024 ** k)), F.lit(unit)))
    text = expr.otherwise(F.concat(_one_decimal(v / float(1024 ** 5)), F.lit("PB")))
    return F.when(v.isNotNull(), text)


def size_mb(n, digits: int = 2) -> Column:
    """``round(bytes / 2^20, 2)`` with Python's half-even rule."""
    return F.bround(_c(n).cast("double") / float(MIB), digits)


def truncate(text, length: int = 200) -> Column:
    """first ``length`` characters of a message."""
    return F.substring(_c(text), 1, length)
