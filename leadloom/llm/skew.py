"""A join of many rows to one row for each key, in which no key is gathered in one task however many rows have it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.scratch import materialize

#: A key is hot when more than one in HOT_SHARE of all rows have it: fewer than HOT_SHARE keys can be.
HOT_SHARE = 1000


def join_one(rows: DataFrame, ones: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of ``ones``, which has one row for each value of ``key`` and in ``size`` the number of rows with it.

    The rows of ``ones`` for hot keys, under HOT_SHARE of them whatever the input, are broadcast; the others are joined by
    sorting. Rows whose key is null or not in ``ones`` go.
    """
    total = rows.count()
    kept = ones.drop(size)
    hot = materialize(ones.where(F.col(size) * HOT_SHARE > total).drop(size), "hot-keys")
    of_hot = rows.join(F.broadcast(hot), key)
    of_rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").hint("merge").join(kept, key)
    return of_hot.select(*of_rest.columns).unionByName(of_rest)
