"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Similarities are ranked at 12 digits: enough to tell near ties apart, and coarse
# enough that a different order of summation does not.  Reports round to 6.
RANK_DIGITS = 12
SCORE_DIGITS = 6


def score(c: Column | str) -> Column:
    """A similarity as it is ranked."""
    return F.round(F.col(c) if isinstance(c, str) else c, RANK_DIGITS)


def shown(c: Column | str) -> Column:
    """A score as a report shows it."""
    return F.round(F.col(c) if isinstance(c, str) else c, SCORE_DIGITS)
