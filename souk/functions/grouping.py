"""Group-wise helpers that never gather a group's rows in one task.

Both reduce on the map side before anything is shuffled, so a key that holds a large share of
all rows costs its reducer no more than a few rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One whole row per key: the first by ``order_by``, then by the other columns.

    NULL key parts compare equal. An aggregate rather than ``row_number``: a window would move
    every copy of a key to one task.
    """
    return _extreme(df, keys, order_by, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One whole row per key: the last by ``order_by``, then by the other columns."""
    return _extreme(df, keys, order_by, F.max)


def _extreme(df, keys, order_by, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = [*order_by, *rest]
    if not packed:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(pick(F.struct(*packed)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def lookup_ids(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of ``column``, to be joined with rows among which a value may be hot.

    Distinct takes the repeats out of this side. The values are then computed anew (to the same
    value): Spark no longer sees them as partitioned by ``column`` and shuffles them to the join,
    and adaptive execution splits a hot key only if both sides come straight from a shuffle.
    """
    unique = df.select(column).distinct()
    return unique.select(F.greatest(column, column).alias(column))


_STEPS = {"sum": F.sum, "min": F.min, "max": F.max}


def profile(
    df: DataFrame,
    keys: Sequence[str],
    *,
    rows: str,
    totals: dict[str, tuple[str, Column]] | None = None,
    top: dict[str, str] | None = None,
    distinct: dict[str, str] | None = None,
    top_counts_null: bool = False,
) -> DataFrame:
    """Per key: row count, totals, most frequent values and distinct counts in one scan.

    * ``totals``: output -> (``sum`` | ``min`` | ``max``, expression)
    * ``top``: output -> column whose most frequent value is wanted (tie: lowest value);
      NULLs compete only with ``top_counts_null``
    * ``distinct``: output -> column whose distinct non-NULL values are counted

    First GROUPING SETS count each (key, value); the second step picks per key. ``mode()`` would
    hold all values of a key in one buffer and fall back to sorting the raw rows.
    """
    totals, top, distinct = totals or {}, top or {}, distinct or {}
    dims = list(dict.fromkeys([*top.values(), *distinct.values()]))
    named = {d: f"_d{i}" for i, d in enumerate(dims)}
    base = df.select(
        *keys,
        *[F.col(d).alias(a) for d, a in named.items()],
        *[expr.alias(f"_t_{out}") for out, (_, expr) in totals.items()],
    )
    fine = base.groupingSets([[*keys, a] for a in named.values()], *keys, *named.values()).agg(
        *[F.grouping(a).alias(f"_g{a}") for a in named.values()],
        F.count(F.lit(1)).alias("_n"),
        *[_STEPS[kind](f"_t_{out}").alias(f"_s_{out}") for out, (kind, _) in totals.items()],
    )

    def of(dim: str) -> Column:
        return F.col(f"_g{named[dim]}") == 0

    one = of(dims[0])  # every input row is in this set exactly once
    picks = [F.sum(F.when(one, F.col("_n"))).alias(rows)]
    for out, (kind, _) in totals.items():
        picks.append(_STEPS[kind](F.when(one, F.col(f"_s_{out}"))).alias(out))
    for out, dim in top.items():
        value = F.col(named[dim])
        competes = of(dim) if top_counts_null else of(dim) & value.isNotNull()
        picks.append(F.min_by(value, F.when(competes, F.struct(-F.col("_n"), value))).alias(out))
    for out, dim in distinct.items():
        picks.append(F.count(F.when(of(dim), F.col(named[dim]))).alias(out))
    return fine.groupBy(*keys).agg(*picks)


def always_one_row(report: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """A report of at most one row, with a row of NULLs under ``keys`` if it has none."""
    period = report.sparkSession.range(1).select(*[v.alias(k) for k, v in keys.items()])
    both = report.unionByName(period, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in report.columns if c not in keys])
