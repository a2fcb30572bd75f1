"""Equi-joins that stay balanced when a few keys hold most of the work.

A bot account can own a third of all pull requests, and can be a core contributor of very many repositories too; joined on
``actor_id``, all its pairs would be made by one task. :func:`hot_keys` counts each key on both sides (column-pruned,
partially aggregated) and calls a key *hot* when it holds at least ``1 / shares`` of all pairs. At most ``shares`` keys can:
one job finds the ``shares`` largest and, as an observed metric, the total. The list is bounded by proof whatever the data,
so it is held on the driver and broadcast.

All other keys meet in a plain join, which keeps what its sides bring along (a bucketed table isn't shuffled again). A hot
key's rows are dealt over a grid of cells, as many as its part of the pairs asks for: left rows go to one grid row and are
copied along it, right rows to one grid column. No cell has much more than ``1 / shares`` of all pairs, and both joins
together are exactly the plain join. Without hot keys only the plain join is left. Both sides are read once for either, so
they should be tables, not long plans. ``shares`` is twice the number of shuffle partitions unless given: a key with less is
no burden to one task.

A list may be counted on tables that hold more rows than the join's own sides; then no cell has more than its part of their
pairs. Joins over several stages share such lists. Should a lost executor count some rows of the total twice, a key near the
limit may not be called hot; results don't depend on the list.

A row's place in the grid is a hash of its own columns, never random: a recomputed task deals it to the same cell.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_GRID = ("_cell_i", "_cell_j")


def key_counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys..., name): rows of each key without a null part."""
    present = df.select(*keys).dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def hot_keys(left: DataFrame, right: DataFrame | None, keys: Sequence[str], shares: int | None = None) -> DataFrame:
    """(keys..., _rows, _cols): the keys with at least ``1 / shares`` of all pairs and the shape of their grids.

    Without ``right`` (its keys are unique) only the left rows count and each grid has one column.
    """
    shares = shares or 2 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weights = key_counts(left, keys, "_l")
    if right is None:
        weights = weights.withColumn("_r", F.lit(1).cast("long"))
    else:
        weights = weights.join(key_counts(right, keys, "_r"), list(keys))
    seen = Observation()
    work = weights.withColumn("_work", F.col("_l").cast("double") * F.col("_r")).observe(seen, F.sum("_work").alias("total"))
    most = work.orderBy(F.desc("_work")).limit(shares).toArrow()
    total = seen.get["total"] or 0.0
    hot = left.sparkSession.createDataFrame(most, work.schema).withColumn("_part", F.col("_work") * shares / F.lit(total or 1.0)).filter("_part >= 1")
    cells = F.ceil("_part").cast("int")
    rows = cells if right is None else F.greatest(F.lit(1), F.least(cells, F.ceil(F.sqrt(cells * F.col("_l") / F.col("_r"))).cast("int")))
    return hot.withColumn("_rows", rows).select(*keys, "_rows", F.ceil(cells / F.col("_rows")).cast("int").alias("_cols"))


def _dealt(df: DataFrame, hot: DataFrame, keys: list[str], salt: Sequence[str], own: str, other: str, size: str, copies: str) -> DataFrame:
    """The rows of hot keys with their cell's coordinates: ``own`` by the row's hash below ``size``, ``other`` for all below
    ``copies``."""
    place = F.pmod(F.xxhash64(*(F.col(c) for c in salt)), F.col(size)).cast("int")
    every = F.sequence(F.lit(0), F.col(copies) - 1)
    return df.join(F.broadcast(hot), keys).withColumns({own: place, other: F.explode(every)}).drop(size, copies)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str, condition: Callable[[], Column] | None) -> DataFrame:
    """The plain join on ``keys`` [and condition()], the keys once."""
    if condition is None:
        return left.join(right, keys, how)
    renamed = {c: f"_right_{c}" for c in keys}
    other = right.withColumnsRenamed(renamed)
    on = condition()
    for c in keys:
        on = (F.col(c) == F.col(renamed[c])) & on
    return left.join(other, on, how).drop(*renamed.values())


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Callable[[], Column] | None = None,
    left_salt: Sequence[str] | None = None,
    right_salt: Sequence[str] | None = None,
    hot: DataFrame | None = None,
    shares: int | None = None,
) -> DataFrame:
    """``left`` JOIN ``right`` ON keys [AND condition()], hot keys dealt over a grid; the key columns appear once.

    ``how`` is ``inner``, or ``left``, ``left_semi`` or ``left_anti`` with a ``right`` whose keys are unique; for these only
    left rows are dealt and each right row is copied to its key's cells. The sides share no column names besides the keys.
    The salts are the columns whose hash deals a row (all by default); name those that identify a row, so that no other
    column is kept for it. ``hot`` is a list of :func:`hot_keys` under the same key names; it is counted on the two sides
    unless given.
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"balanced_join supports inner, left, left_semi and left_anti, not {how!r}")
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides besides the keys: {sorted(shared)}")
    hot = hot_keys(left, right if how == "inner" else None, keys, shares) if hot is None else hot.select(*keys, "_rows", "_cols")
    if hot.isEmpty():
        return _joined(left, right, keys, how, condition).select(*_names(left, right, keys, how))
    if how != "inner":
        hot = hot.select(*keys, (F.col("_rows") * F.col("_cols")).alias("_rows"), F.lit(1).alias("_cols"))
    listed = F.broadcast(hot.select(*keys))
    cold = _joined(left.join(listed, keys, "left_anti"), right.join(listed, keys, "left_anti"), keys, how, condition)
    i, j = _GRID
    dealt_left = _dealt(left, hot, keys, left_salt or left.columns, i, j, "_rows", "_cols")
    dealt_right = _dealt(right, hot, keys, right_salt or right.columns, j, i, "_cols", "_rows")
    grid = _joined(dealt_left, dealt_right, [*keys, i, j], how, condition).drop(i, j)
    names = _names(left, right, keys, how)
    return cold.select(*names).union(grid.select(*names))


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_salt: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` ON keys, which ``right`` has once each and neither side as null; the key columns first.

    A single join on the keys and a cell: a left row's cell is the hash of its ``left_salt``, a right row is copied to all cells
    of its key, and keys that aren't hot have one. Unlike :func:`balanced_join` it reads each side once, so ``left`` may be a
    long plan and such joins may follow each other; but it doesn't keep the bucketing of its sides.
    """
    keys = list(keys)
    hot = hot_keys(left, None, keys) if hot is None else hot
    if hot.isEmpty():
        return left.join(right, keys, "left").select(*_names(left, right, keys, "left"))
    cells = F.broadcast(hot.select(*keys, (F.col("_rows") * F.col("_cols")).alias("_cells")))
    most = F.coalesce("_cells", F.lit(1)).cast("int")
    place = F.pmod(F.xxhash64(*(F.col(c) for c in left_salt)), most).cast("int")
    dealt = left.join(cells, keys, "left").withColumn("_cell", place).drop("_cells")
    copied = right.join(cells, keys, "left").withColumn("_cell", F.explode(F.sequence(F.lit(0), most - 1))).drop("_cells")
    return dealt.join(copied, [*keys, "_cell"], "left").select(*_names(left, right, keys, "left"))


def _names(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> list[str]:
    """The keys and the left and, unless only left rows are asked for, the right columns."""
    own = [*keys, *(c for c in left.columns if c not in keys)]
    return own if how in ("left_semi", "left_anti") else [*own, *(c for c in right.columns if c not in keys)]
