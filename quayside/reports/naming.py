"""What the reports share: looking names up in dimensions, and amounts of cents."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.scratch import saved

#: Maps a table's name to its DataFrame.
Tables = Callable[[str], DataFrame]


def attach(rows: DataFrame, side: DataFrame, on: dict[str, str | Column], take: dict[str, str] | list[str] = (), how: str = "left") -> DataFrame:
    """``rows`` with the columns ``take`` (old name: new name, or names to keep) of
    ``side``, joined where its columns (the keys of ``on``) equal what they are mapped to
    in ``rows``. Catalyst decides by size whether a dimension is broadcast."""
    take = take if isinstance(take, dict) else {c: c for c in take}
    keys = [f"__key{k}" for k in range(len(on))]
    side = side.select(*(F.col(c).alias(k) for c, k in zip(on, keys, strict=True)), *(F.col(c).alias(n) for c, n in take.items()))
    same = [(F.col(x) if isinstance(x, str) else x) == F.col(k) for x, k in zip(on.values(), keys, strict=True)]
    return rows.join(side, reduce(lambda a, b: a & b, same), how).drop(*keys)


def lookup(rows: DataFrame, names: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """``rows`` with what ``names`` adds to the table of their distinct ``keys``, one of them null
    or not: the many columns of the rows move once, to meet what was found, however many large
    dimensions there are."""
    found = names(rows.select(*keys).distinct()).withColumnsRenamed({k: f"__found_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__found_{k}")) for k in keys))
    return rows.join(found, same).drop(*(f"__found_{k}" for k in keys))


def lookup_within(rows: DataFrame, names: Callable[[DataFrame], DataFrame], keys: list[str], group: str) -> DataFrame:
    """``rows`` with what ``names`` adds to their ``keys``, null or not, for rows that lie dealt by
    ``group`` and stay so: the distinct keys of each group alone go to the names, and what is found
    comes back to the group. Rows without a group leave. The rows of a group are compared with all
    keys of it, since an equality of keys would deal by them as well."""
    rows = rows.filter(F.col(group).isNotNull())
    found = names(rows.select(*keys, group).distinct()).withColumnsRenamed({k: f"__found_{k}" for k in (*keys, group)})
    on = F.col(group) == F.col(f"__found_{group}")
    for k in keys:
        on &= alike(F.col(k), F.col(f"__found_{k}")) | (F.col(k).isNull() & F.col(f"__found_{k}").isNull())
    return rows.join(found, on).drop(*(f"__found_{k}" for k in (*keys, group)))


def lookup_all(rows: DataFrame, names: Callable[[DataFrame], DataFrame], keys: list[str], group: str) -> DataFrame:
    """``lookup_within``, and rows without a group, if there are any, which go to the names themselves."""
    strays, found = rows.filter(F.col(group).isNull()), lookup_within(rows, names, keys, group)
    return found if strays.select(group).isEmpty() else found.unionByName(names(strays))


#: So many hashes, a whole number each, may be broadcast.
MOST_SHARED = 1 << 20


def distinct_rows(rows: DataFrame, own: list[Column | str], names: Callable[[DataFrame], DataFrame], more: list[str]) -> DataFrame:
    """The distinct rows of what ``rows`` have of their own and of the columns ``more`` that ``names``
    adds, which makes no equal rows of one. Each row's hash of its own is moved first: rows that share
    none with another equal none and stay where they lie. The rest are compared in full, and so
    are all where too many share theirs."""
    digest = F.xxhash64(*own).alias("__hash")
    counts = rows.select(digest).groupBy("__hash").agg(F.count(F.lit(1)).alias("n"))
    shared = saved(counts.filter("n > 1").select("__hash"), "shared")
    n, named = shared.count(), names(rows)
    if n == 0:
        return named.select(*own, *more)
    if n > MOST_SHARED:
        return named.select(*own, *more).distinct()
    hashed = named.select(digest, *own, *more)
    alone, others = (hashed.join(F.broadcast(shared), "__hash", how).drop("__hash") for how in ("left_anti", "left_semi"))
    return alone.unionByName(others.distinct())


def alike(a: Column, b: Column) -> Column:
    """Equality in a form by which Catalyst does not deal the rows of a join."""
    return a.between(b, b)


def only_row(rows: DataFrame) -> DataFrame:
    """The one row that ``rows`` has, if any; more raise. An aggregate, so it may be broadcast."""
    one = rows.agg(*(F.first(c).alias(c) for c in rows.columns), F.count(F.lit(1)).alias("__n"))
    single = F.when(F.col("__n") > 1, F.raise_error(F.lit("a look-up of one row found several")).cast("boolean")).otherwise(F.col("__n") == 1)
    return one.filter(single).drop("__n")


def prefixed(rows: DataFrame, prefix: str) -> DataFrame:
    """``rows`` with ``prefix`` before every column's name."""
    return rows.select(*(F.col(c).alias(prefix + c) for c in rows.columns))


def zero(*columns: str) -> Column:
    """The sum of columns, nulls as 0."""
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0)) for c in columns))


def dollars(cents: Column) -> Column:
    return cents / 100


def money(*columns: str) -> list[Column]:
    """Columns of cents in dollars, nulls as 0, under their names."""
    return [dollars(zero(c)).alias(c) for c in columns]


def plain_money(*columns: str) -> list[Column]:
    """Columns of cents in dollars, nulls as they are, under their names."""
    return [dollars(F.col(c)).alias(c) for c in columns]


def day(key: str | Column) -> Column:
    """A yyyymmdd number as a time without zone."""
    key = F.col(key) if isinstance(key, str) else key
    return F.to_timestamp_ntz(key.cast("string"), F.lit("yyyyMMdd"))
