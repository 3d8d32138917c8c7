"""Fixed-decimal text (P5).

Numbers are rounded as numbers first and formatted last, so the text does not
depend on how a formatter rounds a binary tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c: Column, digits: int, suffix: str = "") -> Column:
    fmt = f"%.{digits}f" + suffix.replace("%", "%%")
    return F.format_string(fmt, F.round(c, digits))


def fixed_or_dash(c: Column, digits: int) -> Column:
    """Positive values as fixed text, everything else as ``--``."""
    return F.when(c > 0, fixed(c, digits)).otherwise(F.lit("--"))
