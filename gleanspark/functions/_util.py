from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, fn) -> Column:
    """Evaluate ``c`` once and pass it to ``fn`` as a lambda variable.

    Inside higher-order functions expressions are evaluated without common
    subexpression elimination, so ``when(f(c), g(c)).otherwise(c)`` would compute a
    heavy ``c`` up to three times; binding it first computes it once.
    """
    return F.element_at(F.transform(F.array(c), fn), 1)
