"""Exact quantiles of many columns by histograms of ever finer digits, without sorting or gathering a column.

One scan counts the rows of all columns by a first digit: the sign and size of the value, a sixteenth of a power of two wide. The
running counts say in which bin each wanted rank lies; the next scan counts the rows of those bins alone by which of
65,536 equal parts of the bin's range they lie in, and so on. A bin whose least and greatest value agree, or whose first or last
row is wanted, settles at once. A part is a 2^-20 of the one before, so four scans reach single doubles and two or three are
usual. A task holds at most 65,536 counts per column and open bin, however many rows there are and however they
are distributed, and no step is decided by a sample.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators.stats import col, one_row

PARTS = 65_535
FIRST, MIDDLE = 16, 1 << 16  # bins per power of two, and a number above all their places
COLUMNS = 100                # per scan
ACCURACY = 10_000            # percentile_approx: rank error of at most rows / ACCURACY


def interpolate(low: float, high: float, at: float) -> float:
    """The value at a place between two neighbours, in the arithmetic of ``percentile``."""
    if low == high:
        return low
    return (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def _size_bin(x: Column) -> Column:
    """A whole number that rises with the value: logarithms are rounded, but never against their order."""
    place = F.floor(F.least(F.log2(F.abs(x)), F.lit(1100.0)) * FIRST) + MIDDLE
    return F.when(x > 0, place).when(x < 0, -place).otherwise(F.lit(0).cast("bigint"))


def _high_bits(x: Column) -> Column:
    return F.shiftright(x, 48)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated quantiles ``{column: {p: value}}``; nulls and NaN are left out, of no rows they are null."""
    probs = sorted(set(probs))
    cols = list(dict.fromkeys(cols))
    out: dict[str, dict[float, float | None]] = {c: dict.fromkeys(probs) for c in cols}
    for start in range(0, len(cols) if probs else 0, COLUMNS):
        part = cols[start:start + COLUMNS]
        last = F.col("total") - 1
        asked = [f(F.lit(p) * last) for p in probs for f in (F.floor, F.ceil)]
        places = lambda total: {k for p in probs for k in (math.floor(p * (total - 1)), math.ceil(p * (total - 1)))}
        found = _select(_doubles(df, part), dict.fromkeys(range(len(part)), asked), lambda i, total: places(total), _size_bin)
        for i, (total, values) in found.items():
            for p in probs:
                at = p * (total - 1)
                out[part[i]][p] = interpolate(values[math.floor(at)], values[math.ceil(at)], at)
    return out


def order_statistics(df: DataFrame, ranks: Mapping[str, Iterable[int]], whole: bool = False) -> dict[str, dict[int, float]]:
    """The values at 0-based ranks among the non-null values of each column. Ranks beyond the rows are left out.

    ``whole`` columns are taken as longs, which a double might not tell apart.
    """
    cols, wanted = list(ranks), {c: sorted(set(ks)) for c, ks in ranks.items()}
    asked = {i: [F.lit(k) for k in wanted[c]] for i, c in enumerate(cols)}
    values = df.select(*[col(c).cast("bigint").alias(f"c{i}") for i, c in enumerate(cols)]) if whole else _doubles(df, cols)
    found = _select(values, asked, lambda i, total: [k for k in wanted[cols[i]] if k < total], _high_bits if whole else _size_bin)
    return {c: found[i][1] if i in found else {} for i, c in enumerate(cols)}


def _doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns ``c0``, ``c1``, ... as doubles: null for NaN, one zero for both."""
    doubles = [col(c).cast("double") for c in cols]
    return df.select(*[F.when(~F.isnan(d), d + F.lit(0.0)).alias(f"c{i}") for i, d in enumerate(doubles)])


def _select(
    values: DataFrame, asked: Mapping[int, Sequence[Column]], ranks: Callable, first: Callable[[Column], Column],
) -> dict[int, tuple[int, dict[int, float]]]:
    """``{column: (rows, {rank: value})}``. ``asked`` finds the ranks' bins in the first scan, before the rows are known."""
    cells = [F.struct(F.lit(i).alias("i"), first(F.col(f"c{i}")).alias("digit"), F.col(f"c{i}").alias("v")) for i in asked]
    hits = reduce(or_, [(F.col("i") == i) & _crossed(ks) for i, ks in asked.items()])
    bins = _histogram(values, cells).where(hits).collect()
    found: dict[int, tuple[int, dict[int, float]]] = {b["i"]: (b["total"], {}) for b in bins}
    # bin: its column, and (rank, rows below the bin) for each rank in it
    open_ = {i: (i, [(k, 0) for k in ranks(i, total)]) for i, (total, _) in found.items()}
    while open_:
        wider: dict[tuple, list[tuple[int, int]]] = {}
        for at, (i, places) in open_.items():
            own = [b for b in bins if b["i"] == at]
            for rank, below in places:
                b = next(b for b in own if b["upto"] - b["n"] <= rank - below < b["upto"])
                lowest = below + b["upto"] - b["n"]
                if b["lo"] == b["hi"] or rank == lowest:
                    found[i][1][rank] = b["lo"]
                elif rank == lowest + b["n"] - 1:
                    found[i][1][rank] = b["hi"]
                else:
                    wider.setdefault((i, b["lo"], b["hi"]), []).append((rank, lowest))
        open_ = {at: (i, places) for at, ((i, _, _), places) in enumerate(wider.items())}
        if not open_:
            break
        cells = {}
        for at, (i, lo, hi) in enumerate(wider):
            x = F.col(f"c{i}")
            digit = F.floor((x - F.lit(lo)) / F.lit(float(hi - lo)) * F.lit(float(PARTS)))
            cell = F.struct(F.lit(at).alias("i"), digit.alias("digit"), x.alias("v"))
            cells[i] = cells[i].when(x.between(lo, hi), cell) if i in cells else F.when(x.between(lo, hi), cell)
        touched = reduce(or_, [F.col(f"c{i}").between(lo, hi) for i, lo, hi in wider])
        hits = reduce(or_, [(F.col("i") == at) & _crossed([F.lit(k - below) for k, below in places]) for at, (_, places) in open_.items()])
        bins = _histogram(values.where(touched), list(cells.values())).where(hits).collect()
    return found


def _crossed(ranks: Sequence[Column]) -> Column:
    return reduce(or_, [(F.col("upto") > k) & (F.col("upto") - F.col("n") <= k) for k in ranks])


def _histogram(values: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """Counts, running counts and extremes of the cells ``(i, digit, v)`` by bin and digit."""
    rows = values.select(F.inline(F.array(*cells))).where(F.col("v").isNotNull())
    counted = rows.groupBy("i", "digit").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    group = Window.partitionBy("i")                                            # at most 131,072 rows
    running = group.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumns({"upto": F.sum("n").over(running), "total": F.sum("n").over(group)})


def approx_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY,
) -> dict[str, dict[float, float | None]]:
    """Sketched quantiles in one scan: actual values whose rank is off by at most rows / accuracy."""
    probs = sorted(set(probs))
    got = one_row(df, {c: F.percentile_approx(col(c).cast("double"), probs, accuracy) for c in cols})
    return {c: dict(zip(probs, got[c] or [None] * len(probs))) for c in cols}


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "exact"):
    if method == "exact":
        return exact_quantiles(df, cols, probs)
    if method == "approx":
        return approx_quantiles(df, cols, probs)
    raise ValueError(f"unknown quantile method: {method!r}")
