"""Values that are worked out once and used many times in one column, and word lists as one pattern."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which stands in the plan once: it is the only element of an array that is transformed."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def together(values: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct of ``values``, each of which stands in the plan once."""
    return once(F.struct(*[c.alias(n) for n, c in values.items()]), use)


def filled(value: Column) -> Column:
    """``value``, or null for a blank one; for values that are dear to work out."""
    return once(value, lambda v: F.when(v != "", v))


def any_of(words: Iterable[str]) -> str:
    """A pattern that finds any of ``words`` as they are written."""
    return "|".join(re.sub(r"([\\.+*?^$()\[\]{}|])", r"\\\1", w) for w in words)
