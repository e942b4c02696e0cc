"""Joins to a side that is unique in its key, safe against size and skew.

The right side is a table written to the shared folder, or a tiny one. Its row count,
for files taken from the footers, and the bytes of few rows decide between two ways:

* within both limits: broadcast it; the left side is not shuffled;
* beyond that: shuffle both sides, with hot keys split.

A key is *hot* when more than ``hot_rows`` rows of the left side carry it. There
can be at most ``rows / hot_rows`` such keys, so the list of hot keys is small by
construction and is broadcast, with the number of ways each is split in, its rows over
``hot_rows``. Rows of a hot key are spread over its ways by a hash of the partition they
come from and of the columns that tell them apart; the one matching row of the right
side is copied to each way. Rows without a key match nothing and are spread over all
tasks. All other keys take an ordinary shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

HOT_ROWS = 1_000_000
NULL_WAYS = 1 << 20
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024

_WAYS, _SALT = "_ways", "_salt"


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(f"spark.noticeflow.{name}", str(default)))


@dataclass
class Sized:
    """A side whose size is cheap to learn: written, tiny, or part of such a one."""

    frame: DataFrame
    within: Sized | None = None

    @cached_property
    def is_small(self) -> bool:
        """Whether the side may be broadcast, by its rows and then by their bytes.

        The bytes are only summed up when the rows are few.
        """
        if self.within is not None:
            return self.within.is_small
        if self.frame.count() > _setting(self.frame, "broadcastRows", BROADCAST_ROWS):
            return False
        text = F.octet_length(F.to_json(F.struct(*self.frame.columns)))
        size = self.frame.agg(F.sum(text)).first()[0] or 0
        return size <= _setting(self.frame, "broadcastBytes", BROADCAST_BYTES)


def write_once(df: DataFrame, name: str = "step") -> Sized:
    """Write an intermediate result and go on from the files.

    Used where several plans need the same rows: they are computed once, later
    plans stay short, and a lost executor costs no recomputation.
    """
    return Sized(written(df, name))


def hot_limit(df: DataFrame) -> int:
    """Rows of one key above which the key is hot."""
    return _setting(df, "hotRows", HOT_ROWS)


class Hot:
    """The hot keys of a DataFrame, looked for only when a join asks.

    ``counted`` gives counts that are already there, as ``on`` columns and ``_n``.
    A list made for a DataFrame also serves for any part of it.
    """

    def __init__(self, df: DataFrame, on: list[str], counted: DataFrame | None = None):
        self.df, self.on, self.counted = df, on, counted

    @cached_property
    def keys(self) -> DataFrame | None:
        """The hot keys, written once; None when there are none.

        Counts combine before the shuffle. NULL counts as a key here: many rows
        without a key are as hot as many rows with one.
        """
        counts = self.counted
        if counts is None:
            counts = self.df.groupBy(*self.on).agg(F.count(F.lit(1)).alias("_n"))
        limit = hot_limit(self.df)
        ways = F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias(_WAYS)
        found = counts.filter(F.col("_n") > limit).select(*self.on, ways)
        listed = write_once(found, "hot").frame
        return None if listed.isEmpty() else listed


def _any_null(on: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])


def _with_added(left: DataFrame, right: DataFrame, on: list[str], how: str) -> list[str]:
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on]
    return [*left.columns, *added]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Shuffle join to a right side that is unique in ``on``, hot keys split.

    ``how`` is ``left``, ``left_semi`` or ``left_anti``; NULL keys match nothing.
    ``spread_by`` names columns that differ between rows of one key (all columns
    by default). Without hot keys this is a plain join.
    """
    columns = _with_added(left, right, on, how)
    hot_list = (hot or Hot(left, on)).keys
    if hot_list is None:
        return left.join(right, on, how).select(*columns)
    marked = F.broadcast(hot_list)
    # The partition a row comes from tells copies apart, and is the same on a retry.
    told_apart = F.xxhash64(F.spark_partition_id(), *(spread_by or left.columns))
    # Rows without a key match nothing, so they may go anywhere.
    anywhere = F.when(_any_null(on), F.pmod(told_apart, F.lit(NULL_WAYS)))
    salt = F.when(F.col(_WAYS).isNotNull(), F.pmod(told_apart, F.col(_WAYS)))
    salted = (
        left.join(marked, on, "left")
        .withColumn(_SALT, F.coalesce(anywhere, salt, F.lit(0)).cast("int"))
        .drop(_WAYS)
    )
    each = F.sequence(F.lit(0), F.coalesce(F.col(_WAYS), F.lit(1)) - 1)
    copied = right.join(marked, on, "left").withColumn(_SALT, F.explode(each)).drop(_WAYS)
    return salted.join(copied, [*on, _SALT], how).select(*columns)


def keyed_join(
    left: DataFrame,
    right: Sized,
    on: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Broadcast the right side when its size allows, else spread."""
    if right.is_small:
        columns = _with_added(left, right.frame, on, how)
        return left.join(F.broadcast(right.frame), on, how).select(*columns)
    return spread_join(left, right.frame, on, how, spread_by, hot)


def key_values(table: Sized, key: str) -> Sized:
    """Distinct values of one key column; never more than the table holds."""
    return Sized(table.frame.select(key).distinct(), within=table)
