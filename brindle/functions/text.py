"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lines(text: Column) -> Column:
    """Array of the lines of a text; the newline is the only separator."""
    return F.split(text, "\n")


def tokens(line: Column, separator: str = " ") -> Column:
    """Split on a one-character separator, dropping trailing empty tokens only.

    Leading and inner empty tokens stay, the empty line gives one empty token,
    and a line of separators alone gives none.  Spark's own ``split`` keeps the
    trailing empties, so they are trimmed first.
    """
    if len(separator) != 1:
        raise ValueError("the separator must be one character")
    trimmed = F.rtrim(line) if separator == " " else F.rtrim(line, F.lit(separator))
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, rf"\Q{separator}\E"))
    )
