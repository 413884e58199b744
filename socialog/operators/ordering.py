"""Row numbers, even parts, batches and pages without a single-task sort.

Numbering range-partitions the rows, writes them once with their place (task
number and position in the task) and adds the start of each task. Ties are
spread by their scan position, so neither a hot value nor a pile of copies ends
up in one task. Within groups only the hot ones need that; the others are numbered by a
window.
"""

from __future__ import annotations

from functools import cached_property, reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from socialog.session import written

HOT_ROWS = 1_000_000  # rows of a group that one task sorts
_TASK_BITS = 33  # monotonically_increasing_id keeps the position below this bit


def _placed(df: DataFrame, order: list[Column | str]) -> DataFrame:
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return (
        written(ranged, "placed")
        .withColumn("_task", F.shiftright("_place", _TASK_BITS))
        .withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << _TASK_BITS) - 1)))
        .drop("_place")
    )


def row_index(df: DataFrame, *order: Column | str, name: str = "row_index") -> DataFrame:
    """0-based number of each row in the given order."""
    placed = _placed(df, list(order))
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the range shuffle, so this window and the broadcast
    # are bounded by spark.sql.shuffle.partitions.
    starts = sizes.select(
        "_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        placed.join(F.broadcast(starts), "_task")
        .withColumn(name, F.col("_start") + F.col("_at"))
        .drop("_task", "_at", "_start")
    )


def group_index(
    df: DataFrame,
    group: list[str],
    *order: Column | str,
    name: str = "group_index",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """0-based number of each row within its group; each row is shuffled once.

    Groups are counted first. Those of at most ``hot_rows`` rows are numbered by a window,
    each in its task. A larger one may span many tasks: its rows are range-partitioned
    and only what each task has of it is summed up, a row a task and hot group. A NULL
    key is a group like any other.
    """
    keyed = df.withColumn("_group", F.struct(*group))
    hot = written(
        keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows).select("_group"),
        "hot-groups",
    )
    within = Window.partitionBy(*group).orderBy(*order)
    number = (F.row_number().over(within) - 1).cast("long").alias(name)
    if hot.isEmpty():
        return df.select("*", number)
    cold = keyed.join(hot, "_group", "left_anti").select(*df.columns, number)
    placed = _placed(keyed.join(hot, "_group", "left_semi"), ["_group", *order])
    pieces = placed.groupBy("_group", "_task").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = (
        Window.partitionBy("_group").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = pieces.select(
        "_group",
        "_task",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    # A row for each task and hot group at most: tasks, and rows / hot_rows.
    numbered = placed.join(F.broadcast(carried), ["_group", "_task"]).select(
        *df.columns, (F.col("_at") + F.col("_shift")).alias(name)
    )
    return cold.unionByName(numbered)


def even_part(index: Column, total: Column, parts: int) -> Column:
    """1-based part of a row; part sizes differ by at most one, larger ones first."""
    small = F.floor(total / parts)
    larger = total % parts
    edge = larger * (small + 1)
    return (
        F.when(index < edge, F.floor(index / (small + 1)))
        .otherwise(larger + F.floor((index - edge) / F.greatest(small, F.lit(1))))
        .cast("long")
        + 1
    )


def even_parts(df: DataFrame, parts: int, *order: Column | str) -> DataFrame:
    """Split ordered rows into ``parts`` runs of almost equal length."""
    numbered = row_index(df, *order)
    total = numbered.groupBy().agg((F.max("row_index") + 1).alias("_total"))
    return numbered.withColumn(
        "part", even_part(F.col("row_index"), total.scalar(), parts)
    ).drop("row_index")


def batches(df: DataFrame, group: list[str], size: int, *order: Column | str) -> DataFrame:
    """Batch number (from 1) and batch id of each row within its group."""
    numbered = group_index(df, group, *order)
    number = (F.floor(F.col("group_index") / size) + 1).cast("long")
    return (
        numbered.withColumn("batch_no", number)
        .withColumn("batch_id", F.concat_ws("_", F.lit("batch"), *group, "batch_no"))
        .drop("group_index")
    )


def page_numbers(df: DataFrame, group: list[str], size: int, *order: Column | str) -> DataFrame:
    """1-based page of each row within its group."""
    numbered = group_index(df, group, *order)
    return numbered.withColumn(
        "page_no", (F.floor(F.col("group_index") / size) + 1).cast("long")
    ).drop("group_index")


def after(keys: list[str], token: tuple[Any, ...], reverse: bool = False) -> Column:
    """Rows past ``token`` in key order, as plain comparisons a scan can use."""

    def past(i: int) -> Column:
        here = F.col(keys[i])
        beyond = here < token[i] if reverse else here > token[i]
        same = [F.col(keys[j]) == token[j] for j in range(i)]
        return reduce(lambda a, b: a & b, [*same, beyond])

    lead = F.col(keys[0])
    bound = lead <= token[0] if reverse else lead >= token[0]
    return bound & reduce(lambda a, b: a | b, [past(i) for i in range(len(keys))])


def page_rows(
    df: DataFrame,
    keys: list[str],
    size: int,
    token: tuple[Any, ...] | None = None,
    reverse: bool = False,
) -> DataFrame:
    """At most ``size`` rows past ``token``; ``keys`` must identify a row."""
    chosen = df if token is None else df.filter(after(keys, token, reverse))
    order = [F.col(k).desc() if reverse else F.col(k).asc() for k in keys]
    return chosen.orderBy(*order).limit(size)


class Page:
    """One page of an ordered list."""

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        size: int,
        token: tuple[Any, ...] | None = None,
        reverse: bool = False,
    ):
        self.keys, self.size = keys, size
        self.rows = page_rows(df, keys, size, token, reverse)
        self._ahead = page_rows(df, keys, size + 1, token, reverse)

    @cached_property
    def next_token(self) -> tuple[Any, ...] | None:
        """Keys of the last row, None on the last page; reads ``size + 1`` keys."""
        found = self._ahead.select(*self.keys).collect()
        return tuple(found[self.size - 1]) if len(found) > self.size else None


def page(
    df: DataFrame,
    keys: list[str],
    size: int,
    token: tuple[Any, ...] | None = None,
    reverse: bool = False,
) -> Page:
    """The page past ``token``. Nothing runs before its rows or its token are asked for."""
    return Page(df, keys, size, token, reverse)


def running_sums(
    df: DataFrame, step: str, values: list[str], width: int = 1000, descending: bool = False
) -> DataFrame:
    """Running totals of ``values`` over the whole number ``step``, one row per step.

    Totals of blocks of ``width`` steps are summed first, so the only ordered
    run over all data has one row per block.
    """
    blocks = df.withColumn("_block", F.floor(F.col(step) / width))

    def order(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    before = Window.orderBy(order("_block")).rowsBetween(Window.unboundedPreceding, -1)
    within = (
        Window.partitionBy("_block").orderBy(order(step)).rowsBetween(Window.unboundedPreceding, 0)
    )
    totals = blocks.groupBy("_block").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    carried = totals.select(
        "_block", *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values]
    )
    local = blocks.select(
        *[c for c in df.columns if c not in values],
        "_block",
        *[F.sum(v).over(within).alias(v) for v in values],
    )
    return local.join(carried, "_block").select(
        *[c for c in df.columns if c not in values],
        *[(F.col(v) + F.col(f"_{v}")).alias(v) for v in values],
    )
