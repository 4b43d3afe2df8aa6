"""Text to numbers, strictly.

A cast also accepts Java suffixes (``3F``, ``2D``); these are text, not numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?|INF|[nN]a[nN])\s*$"
BLANK = r"^[\s\p{Z}\x1c-\x1f\x85]*$"


def to_double(c: Column) -> Column:
    """The value of a column as double; text that is not a number gives null."""
    return F.when(c.cast("string").rlike(NUMBER), c.try_cast("double"))
