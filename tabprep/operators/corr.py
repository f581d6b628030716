"""Pearson, Spearman and Kendall correlation of all pairs of numeric columns."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.operators.lookup import BROADCAST_ROWS, heavy_keys, lookup
from tabprep.operators.ordered import ROWS_PER_BUCKET, SAMPLED, OrderedBuckets, running_before
from tabprep.operators.roles import numeric_columns
from tabprep.operators.stats import col, one_row

METHODS = ("pearson", "spearman", "kendall")
PAIRS_PER_JOB = 12
FLAT = 1 << 32
INF = float("inf")


def correlation(
    df: DataFrame, method: str = "pearson", cols: Sequence[str] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``(col_a, col_b, corr)`` for every ordered pair, diagonal included.

    A pair uses the rows where both values are present; a constant column gives null.
    """
    names = numeric_columns(df, cols)
    doubles = df.select(*[col(c).cast("double").alias(c) for c in names])
    if method == "pearson":
        found = _pearson(doubles, names)
    elif method == "spearman":
        found = _spearman(doubles, names, rows_per_bucket)
    elif method == "kendall":
        found = _kendall(doubles, names, rows_per_bucket)
    else:
        raise ValueError(f"unknown correlation method {method!r}, use one of {METHODS}")
    rows = [(a, b, r) for (a, b), r in found.items()] + [(b, a, r) for (a, b), r in found.items() if a != b]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def correlation_matrix(long: DataFrame) -> DataFrame:
    """One row and one column per name."""
    names = sorted(r[0] for r in long.select("col_a").distinct().collect())
    return long.groupBy("col_a").pivot("col_b", names).agg(F.first("corr")).orderBy("col_a")


def _null_counts(df: DataFrame, names: Sequence[str]) -> dict[str, int]:
    return one_row(df, {c: F.count_if(col(c).isNull()) for c in names}) if names else {}


def _bounded(r: float | None) -> float | None:
    return None if r is None else max(-1.0, min(1.0, r))


def _pearson(df: DataFrame, names: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """Two scans: nulls and means, then the moments of all pairs.

    Columns without nulls share one deviation per column. A pair with nulls has its own rows, so its moments are
    sums of products around the column means, which are far cheaper than one running variance per pair and side.
    """
    first = one_row(df, {(c, m): e for c in names for m, e in (
        ("nulls", F.count_if(col(c).isNull())), ("mean", F.avg(col(c))))})
    whole = {c for c in names if not first[c, "nulls"]}
    found: dict[tuple[str, str], float | None] = {}
    exprs: dict[tuple, Column] = {(c, None, "std"): F.stddev_pop(col(c)) for c in names}
    partial = []
    for a, b in combinations(names, 2):
        if a in whole and b in whole:
            exprs[a, b, "both"] = F.covar_pop(col(a), col(b))
        elif first[a, "mean"] is None or first[b, "mean"] is None:
            found[a, b] = None
        else:
            partial.append((a, b))
            x, y = f"(`{a}` - {first[a, 'mean']!r}D)", f"(`{b}` - {first[b, 'mean']!r}D)"
            both = f"filter (where `{a}` is not null and `{b}` is not null)"
            for part in ("x", "y", "xx", "yy", "xy"):
                product = " * ".join(x if side == "x" else y for side in part)
                exprs[a, b, part] = F.expr(f"sum({product}) {both}")
            exprs[a, b, "n"] = F.expr(f"count(*) {both}")
            for side, c in (("x", a), ("y", b)):
                exprs[a, b, "constant", side] = F.expr(f"min(`{c}`) {both} = max(`{c}`) {both}")
    got = one_row(df, exprs)
    for a, b in combinations(names, 2):
        if (a, b, "both") in got:
            spread = (got[a, None, "std"] or 0.0) * (got[b, None, "std"] or 0.0)
            found[a, b] = _bounded(got[a, b, "both"] / spread) if spread else None
    for a, b in partial:
        n, x, y, xx, yy, xy = (got[a, b, part] for part in ("n", "x", "y", "xx", "yy", "xy"))
        flat = not n or got[a, b, "constant", "x"] or got[a, b, "constant", "y"]
        spread = 0.0 if flat else math.sqrt((xx - x * x / n) * (yy - y * y / n))
        found[a, b] = _bounded((xy - x * y / n) / spread) if spread else None
    found.update({(c, c): 1.0 if got[c, None, "std"] else None for c in names})
    return found


def _spearman(df: DataFrame, names: Sequence[str], rows_per_bucket: int) -> dict[tuple[str, str], float | None]:
    """Pearson correlation of average ranks.

    Ranks of a pair with nulls are taken over the rows where both are present; columns without nulls share one ranking.
    A column's values are counted once, with a count per ranking, and run up once; its ranks are then joined to the rows
    by one join. What that gives, the rows' ranks alone, is kept, and the products of any number of pairs are sums over it.
    """
    nulls = _null_counts(df, names)
    others = {c: list(dict.fromkeys(o if nulls[o] and o != c else None for o in names)) for c in names}
    pairs = [*combinations(names, 2), *[(c, c) for c in names]]
    side = {(c, o): f"__r{i}_{others[c].index(o if nulls[o] and o != c else None)}" for i, c in enumerate(names) for o in names}
    most = max(map(len, others.values()), default=0)

    def cell(i: int, c: str) -> Column:
        counted = [F.lit(True) if o is None else col(o).isNotNull() for o in others[c]] + [F.lit(False)] * (most - len(others[c]))
        return F.struct(F.lit(i).alias("id"), col(c).alias("value"), *[k.cast("bigint").alias(f"k{j}") for j, k in enumerate(counted)])

    sums = [F.sum(f"k{j}").alias(f"n{j}") for j in range(most)]
    counts = (
        df.select(F.inline(F.array(*[cell(i, c) for i, c in enumerate(names)]))).where(F.col("value").isNotNull())
        .groupBy("id", "value").agg(*sums, F.count("*").alias("n")).persist()
    )
    ranked = None
    try:
        facts = {r["id"]: r for r in counts.groupBy("id").agg(
            F.count("*").alias("values"), F.sum("n").alias("rows"), *[F.sum(f"n{j}").alias(f"n{j}") for j in range(most)]).collect()}
        ranks = average_ranks(counts, {i: r["values"] for i, r in facts.items()}, most, rows_per_bucket).persist()
        ranked = _with_ranks(df, names, ranks, facts, {c: len(others[c]) for c in names}).persist()
        middle = {f"__r{i}_{j}": (facts[i][f"n{j}"] + 1) / 2 for i in facts for j in range(most)}
        exprs: dict[tuple, Column] = {}
        for a, b in pairs:
            x, y = side[a, b], side[b, a]
            if x in middle and y in middle:
                dx, dy = f"({x} - {middle[x]}D)", f"({y} - {middle[y]}D)"
                for part, product in (("xy", f"{dx} * {dy}"), ("xx", f"{dx} * {dx}"), ("yy", f"{dy} * {dy}")):
                    exprs[a, b, part] = F.expr(f"sum(__n * {product}) filter (where {x} is not null and {y} is not null)")
        got = one_row(ranked, exprs)
    finally:
        counts.unpersist()
        if ranked is not None:
            ranks.unpersist()
            ranked.unpersist()
    found: dict[tuple[str, str], float | None] = {}
    for a, b in pairs:
        spread = math.sqrt((got.get((a, b, "xx")) or 0.0) * (got.get((a, b, "yy")) or 0.0))
        found[a, b] = _bounded(got[a, b, "xy"] / spread) if spread else None
    return found


def average_ranks(counts: DataFrame, sizes: Mapping[int, int], rankings: int, rows_per_bucket: int) -> DataFrame:
    """Add ``r0``, ``r1``, ... to ``(id, value, n0, n1, ...)``, per id: ties of any size are one row when the counts are run up.

    Ids with few values are ranked side by side, one task each; the others are cut into buckets.
    """
    few = [i for i, values in sizes.items() if values <= rows_per_bucket]
    past = "over (partition by id order by value rows between unbounded preceding and 1 preceding)"
    parts = [counts.where(F.col("id").isin(few)).withColumns({
        f"before{j}": F.expr(f"coalesce(sum(n{j}) {past}, 0L)") for j in range(rankings)})]
    for i in sizes.keys() - set(few):
        mine = counts.where(F.col("id") == i)
        buckets = OrderedBuckets.fit(mine, ["value"], rows_per_bucket, rows=sizes[i])
        parts.append(running_before(mine, "value", {f"before{j}": f"n{j}" for j in range(rankings)}, buckets))
    return reduce(DataFrame.unionByName, parts).withColumns({
        f"r{j}": F.expr(f"before{j} + (n{j} + 1) / 2.0D") for j in range(rankings)})


def _with_ranks(df, names, ranks, facts, rankings: Mapping[str, int]) -> DataFrame:
    """The ranks of every row, one join per column, and ``__n``, how many equal rows it stands for.

    A row has a rank of a pair's ranking even where the other value is missing; sums leave it out, as that has none.
    """
    ranked = df.select(*[col(c) for c in names]).withColumn("__n", F.lit(1))
    if any(r["values"] > BROADCAST_ROWS for r in facts.values()):
        # Equal rows become one before they are spread by their hash.
        ranked = ranked.groupBy(*[col(c) for c in names]).agg(F.count(F.lit(1)).alias("__n"))
    wanted = ["__n"]
    for i, c in enumerate(names):
        named = [f"__r{i}_{j}" for j in range(rankings[c])]
        if i not in facts:
            continue
        entries = ranks.where(F.col("id") == i)
        heavy: list[float] = []
        if facts[i]["values"] > BROADCAST_ROWS:
            heavy = sorted(heavy_keys(entries, "value", "n", facts[i]["rows"]))
        wide = entries.select("value", *[F.col(f"r{j}").alias(r) for j, r in enumerate(named)])
        ranked = lookup(ranked, wide, c, "value", named, facts[i]["values"], heavy)
        wanted += named
    return ranked.select(*wanted)


def _kendall(df: DataFrame, names: Sequence[str], rows_per_bucket: int) -> dict[tuple[str, str], float | None]:
    """Tau-b of all pairs of columns, some pairs to a job; see ``inversions``."""
    found: dict[tuple[str, str], float | None] = {}
    pairs = list(combinations(names, 2))
    for start in range(0, len(pairs), PAIRS_PER_JOB):
        part = pairs[start:start + PAIRS_PER_JOB]
        cells = F.array(*[F.struct(F.lit(i).alias("id"), col(a).alias("x"), col(b).alias("y")) for i, (a, b) in enumerate(part)])
        both = df.select(F.inline(cells)).where(F.col("x").isNotNull() & F.col("y").isNotNull())
        found.update({part[i]: tau for i, tau in kendall_tau_b(both, len(part), rows_per_bucket).items()})
    counts = one_row(df, {c: F.count(col(c)) for c in names})
    found.update({(c, c): 1.0 if counts[c] else None for c in names})
    return found


def kendall_tau_b(pairs: DataFrame, ids: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[int, float | None]:
    """Tau-b of the columns x and y of every ``id`` of a table without nulls. Equal rows are counted first, on the map side."""
    cells = pairs.groupBy("id", "x", "y").agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        n = F.col("n").cast("double")
        sides = [
            cells.groupBy("id", *by).agg(F.sum("n").alias("n")).groupBy("id").agg(
                F.lit(name).alias("side"), F.sum(n * (n - 1) / 2).alias("tied"), F.sum("n").alias("rows"), F.count("*").alias("cells"))
            for name, by in (("both", ["x", "y"]), ("x", ["x"]), ("y", ["y"]))
        ]
        facts = {(r["id"], r["side"]): r for r in reduce(DataFrame.unionByName, sides).collect()}
        sizes = {i: facts[i, "both"]["cells"] for i in range(ids) if (i, "both") in facts}
        crossed = inversions(cells, sizes, rows_per_bucket)
    finally:
        cells.unpersist()
    found: dict[int, float | None] = {}
    for i in range(ids):
        rows = facts[i, "both"]["rows"] if i in sizes else 0
        whole = rows * (rows - 1) / 2
        in_x, in_y, both = (facts[i, s]["tied"] if i in sizes else 0.0 for s in ("x", "y", "both"))
        spread = math.sqrt((whole - in_x) * (whole - in_y))
        found[i] = _bounded((whole - in_x - in_y + both - 2 * crossed[i]) / spread) if spread else None
    return found


def weighted_inversions(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """The sum of ``n * m`` over all pairs of rows of which one has the smaller x and the larger y.

    Rows in order of x, then y, are merged by the digits of their rank in y: two ranks first differ in one bit, where
    the row with 0 meets the weight of earlier rows with 1 that agree in all bits before.
    """
    order = np.lexsort((y, x))
    rank = np.unique(y, return_inverse=True)[1][order]
    weight, total = n[order].astype(np.float64), 0.0
    for bit in range(int(rank.max(initial=0)).bit_length() - 1, -1, -1):
        group = rank >> (bit + 1)
        ones = (rank >> bit) & 1 == 1
        run = np.cumsum(np.where(ones, weight, 0.0))
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        before = np.repeat(np.concatenate(([0.0], run[first[1:] - 1])), np.diff(np.append(first, len(rank))))
        total += float((weight * (run - before))[~ones].sum())
        again = np.argsort(rank >> bit, kind="stable")
        rank, weight = rank[again], weight[again]
    return total


def inversions(cells: DataFrame, sizes: Mapping[int, int], rows_per_bucket: int) -> dict[int, float]:
    """Per id the weighted inversions of ``(id, x, y, n)``, whose (x, y) are distinct.

    Ids with few cells are counted in one task each. The cells of others are cut into ranges of x and into ranges of y. Two
    cells are in one range of x, and counted there; or in different ones but one range of y, and counted there by the
    place of their ranges of x; or differ in both, and are counted on the table of both places, by this function again.
    A value that fills a range has it to itself and nothing to count in it.
    """
    def count(table: pa.Table) -> pa.Table:
        x, y, n = (table.column(c).to_numpy() for c in ("x", "y", "n"))
        return pa.table({"id": pa.array([table.column("id")[0].as_py()], pa.int32()), "total": [weighted_inversions(x, y, n)]})

    few = [i for i, size in sizes.items() if size <= max(rows_per_bucket, 64)]
    found = dict.fromkeys(sizes, 0.0)
    if few:
        small = cells.where(F.col("id").isin(few)).groupBy("id").applyInArrow(count, "id int, total double")
        found.update({r["id"]: r["total"] for r in small.collect()})
    for i in sizes.keys() - set(few):
        mine = cells.where(F.col("id") == i).select("x", "y", "n")
        cut = mine
        for c in ("x", "y"):
            splits = _ranges(mine, c, sizes[i], rows_per_bucket)
            cut = Bucketizer(splits=[-INF, *splits, INF], inputCol=c, outputCol=f"p{c}").transform(cut)
        cut = cut.withColumns({"px": F.col("px").cast("int"), "py": F.col("py").cast("int")})
        sides = F.array(
            F.struct(F.lit(0).alias("side"), F.col("px").alias("range"), "x", "y", "n"),
            F.struct(F.lit(1).alias("side"), F.col("py").alias("range"), F.col("px").cast("double").alias("x"), "y", "n"))
        rows = cut.select(F.inline(sides)).withColumn("id", F.lit(i))
        spans = rows.groupBy("side", "range").agg(F.min("x") == F.max("x"), F.min("y") == F.max("y")).collect()
        flat = [side * FLAT + r for side, r, one_x, one_y in spans if one_x or one_y]
        rows = rows.where(~(F.col("side") * FLAT + F.col("range").cast("bigint")).isin(flat))
        inside = rows.groupBy("side", "range").applyInArrow(count, "id int, total double").agg(F.sum("total")).first()[0]
        table = cut.groupBy(F.col("px").cast("double").alias("x"), F.col("py").cast("double").alias("y")).agg(F.sum("n").alias("n"))
        table = table.withColumn("id", F.lit(i)).persist()
        try:
            found[i] = (inside or 0.0) + inversions(table, {i: table.count()}, rows_per_bucket)[i]
        finally:
            table.unpersist()
    return found


def _ranges(cells: DataFrame, c: str, size: int, rows_per_bucket: int) -> list[float]:
    """Bounds of ranges of a value by sampled quantiles; a value that is more than one of them gets a range to itself.

    Never so many that the table of places could be as large as what is cut.
    """
    wanted = max(2, min(math.ceil(size / rows_per_bucket), math.isqrt(size) // 4))
    share = min(1.0, SAMPLED * wanted / size)
    drawn = cells.select(c) if share == 1.0 else cells.select(c).sample(share, seed=3)
    drawn = np.sort(drawn.toArrow().column(0).to_numpy())
    values, times = np.unique(drawn[np.arange(1, wanted) * len(drawn) // wanted] if len(drawn) else drawn, return_counts=True)
    return sorted({*values.tolist(), *np.nextafter(values[times > 1], INF).tolist()} - {-INF, INF})
