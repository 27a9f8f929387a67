"""Exact quantiles (linear interpolation) for any number of groups of any size, by digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import broadcast_if_small, store, work_folder, written

#: Values a digit can take after the first one.
BASE = 2048


def _match(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def _first_digit(x: Column) -> Column:
    """Sign and binary exponent: rises with the value, and values that share it lie within a factor of two."""
    exponent = F.least(F.floor(F.log2(F.abs(x))), F.lit(1100)).cast("int") + 1101  # infinity gets a digit of its own
    return F.when(x > 0, exponent).when(x < 0, -exponent).otherwise(0)


def _next_digit(x: Column) -> Column:
    """The cell's range cut into equal steps. Subtraction and division keep order, so digits never contradict the values."""
    return F.floor((x - F.col("low")) / (F.col("high") - F.col("low")) * BASE).cast("int")


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] = (), stored: bool = False) -> DataFrame:
    """One row per group: ``by``, ``n`` and a column per entry of ``probs``. Nulls and NaN are left out.

    Values are read from a stored frame (``stored`` states that ``df`` is one) in rounds. The first counts the sign and exponent of
    every value, each further one the next digit of the values in cells that hold a wanted rank. Counts are merged before the
    shuffle, so a round moves at most a few thousand cells a group and task, and never rows. A cell is done when its least
    and greatest value are equal, at the latest after six rounds as a double has 52 bits behind the exponent.
    """
    by, names = list(by), list(probs)
    keys = [f"_g{i}" for i in range(len(by))] or ["_g0"]
    group = [F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("_g0")]
    place = lambda p, n: F.lit(p) * (n - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(p, F.col("n"))), F.ceil(place(p, F.col("n")))) for p in probs.values()])))
    holds_rank = F.exists(ranks, lambda r: (r >= F.col("start")) & (r < F.col("stop")))

    def cells(rows: DataFrame, digit: Column, cell: list[str], total: Column, start: Column) -> DataFrame:
        """Cells that hold a wanted rank: least and greatest value, and the ranks ``start`` up to before ``stop`` that they cover."""
        counted = rows.groupBy(*cell, digit.alias("digit")).agg(F.count(F.lit(1)).alias("rows"), F.min("x").alias("least"), F.max("x").alias("most"))
        inside = Window.partitionBy(*cell)  # digits of one cell
        stop = start + F.sum("rows").over(inside.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
        found = counted.withColumns({"_n": total.over(inside) if total is not None else F.col("n"), "stop": stop})
        return found.select(*keys, F.col("_n").alias("n"), F.col("least").alias("low"), F.col("most").alias("high"),
                            (F.col("stop") - F.col("rows")).alias("start"), "stop").where(holds_rank)

    with work_folder(df.sparkSession, "quantile-rows") as folder:
        x = F.col(value).cast("double")
        rows = df.select(*group, x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
        rows = rows if stored else store(rows, folder)
        state = written(cells(rows, _first_digit(F.col("x")), keys, F.sum("rows"), F.lit(0)), "quantile-cells")
        done = state.where("low = high")
        while (open_cells := state.where("low < high")).count():
            wanted = open_cells.select(*[F.col(k).alias(f"_c{k}") for k in keys], "n", "low", "high", "start")
            inside = rows.join(broadcast_if_small(wanted), _match(keys, [f"_c{k}" for k in keys]) & F.col("x").between(F.col("low"), F.col("high")))
            state = written(cells(inside, _next_digit(F.col("x")), [*keys, "n", "start"], None, F.col("start")), "quantile-cells")
            done = done.unionByName(state.where("low = high"))

    n = F.col("n")
    at = lambda rank: F.max(F.when((F.col("start") <= rank) & (rank < F.col("stop")), F.col("low")))
    ends = {m: (F.floor(place(p, n)), F.ceil(place(p, n))) for m, p in probs.items()}
    out = done.groupBy(*keys, "n").agg(*[at(r).alias(f"_{side}_{m}") for m, two in ends.items() for side, r in zip("lu", two)])
    return out.select(
        *[F.col(k).alias(c) for k, c in zip(keys, by)], "n",
        *[(F.col(f"_l_{m}") + (F.col(f"_u_{m}") - F.col(f"_l_{m}")) * (place(probs[m], n) - F.floor(place(probs[m], n)))).alias(m) for m in names])


def tukey_fences(quartiles: DataFrame, q1: str = "q1", q3: str = "q3") -> DataFrame:
    """Add ``low`` and ``high``: quartiles -/+ 1.5 times their distance."""
    spread = F.col(q3) - F.col(q1)
    return quartiles.withColumns({"low": F.col(q1) - 1.5 * spread, "high": F.col(q3) + 1.5 * spread})
