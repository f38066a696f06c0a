"""Text expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, and the four ASCII separators that Python also counts as white space.
SPACE = r"[\s\x1c-\x1f]"
WS_RUN = rf"(?U){SPACE}+"
WS_ENDS = rf"(?U)^{SPACE}+|{SPACE}+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without outer Unicode white space; null stays null."""
    return F.regexp_replace(col(c), WS_ENDS, "")


def squeeze(c: Column | str) -> Column:
    """Outer white space removed and inner runs made one space; null stays null."""
    return F.regexp_replace(strip(c), WS_RUN, " ")


def plain_form(c: Column | str) -> Column:
    """Lower case, squeezed, null as ''. Two texts are the same iff their plain forms are equal."""
    return F.coalesce(F.lower(squeeze(c)), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for null, '' and white space only."""
    return F.coalesce(strip(c), F.lit("")) == ""
