"""Text forms used in keys and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spintally.schema import COMPLETION_KEY_PREFIX, REPORT_BAR_WIDTH


def song_slug(name: str) -> Column:
    return F.replace(F.lower(F.col(name)), F.lit(" "), F.lit("-"))


def completion_key(song: str = "song_id") -> Column:
    return F.concat(F.lit(COMPLETION_KEY_PREFIX), F.col(song))


def percent_text(rate: str) -> Column:
    """The rate as a percentage with one decimal, ties judged on the exact double and to even.

    ``format_string`` rounds the printed digits half up, which differs on values
    such as 12.25. The percentage is split into a part on a coarse binary grid and
    a small remainder so that twenty times each part is exact, and the sign of
    ``excess`` says on which side of the tie the value lies.
    """
    percent = F.col(rate) * F.lit(100.0)
    grid = F.lit(float(2**20))
    coarse = F.floor(percent * grid).cast("double") / grid
    rest = percent - coarse
    tenths = F.floor(coarse * F.lit(10.0))
    excess = (coarse * 20.0 - (tenths * 2 + 1).cast("double")) + rest * 20.0
    rounds_up = (excess > 0.0) | ((excess == 0.0) & (tenths % 2 != 0))
    shown = tenths + rounds_up.cast("bigint")
    whole = F.floor(shown / F.lit(10)).cast("string")
    return F.concat(whole, F.lit("."), (shown % 10).cast("string"), F.lit("%"))


def bar_length(plays: str, top: str, width: int = REPORT_BAR_WIDTH) -> Column:
    """Length of a report bar relative to the largest value, at least one."""
    share = F.col(plays) / F.greatest(F.col(top), F.lit(1)).cast("double")
    return F.greatest(F.lit(1), F.bround(share * F.lit(float(width)), 0)).cast("bigint")
