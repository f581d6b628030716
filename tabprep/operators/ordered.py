"""Ordered fills and running counts without a one-task window.

Rows are cut into buckets by literal bounds on the order keys, so the cut is the same on every recomputation. Work
runs inside the buckets, and a small table with one row per bucket carries values from bucket to bucket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.operators.stats import col, one_row

ROWS_PER_BUCKET = 1_000_000
SAMPLED = 20                 # sampled rows per bucket that is wanted: eight bytes each, all that grows on the driver
HEAVY = 2                    # a bucket of more than so many times the wanted rows is cut again
CHUNK = 5                    # bytes of a text that one number holds, with their number
INF = float("inf")
BUCKET, DATA, TIE = "__bucket", "__data", "__tie"


@dataclass(frozen=True)
class _Part:
    """A number read off a key. The numbers of a key, one after the other, order rows as the key does."""

    key: str
    kind: str
    at: int = 0

    def number(self) -> Column:
        """0 for null, which a part of its own tells apart."""
        return F.coalesce(self._number(), F.lit(0.0))

    def _number(self) -> Column:
        c = col(self.key)
        if self.kind == "null":
            return F.when(c.isNull(), F.lit(0.0)).otherwise(F.lit(1.0))
        if self.kind == "nan":
            return F.when(F.isnan(c), F.lit(1.0)).otherwise(F.lit(0.0))
        if self.kind == "rest":                        # of a whole number or decimal that a double has rounded
            kind = f"decimal(38,{self.at})"
            return (c.cast(kind) - c.cast("double").try_cast(kind)).cast("double")
        if self.kind == "text":
            piece = F.substring(F.encode(c, "UTF-8"), CHUNK * self.at + 1, CHUNK)
            whole = F.conv(F.rpad(F.hex(piece), 2 * CHUNK, "0"), 16, 10).cast("double")
            return whole * (CHUNK + 1) + F.octet_length(piece)
        if self.kind == "time":
            c = F.unix_micros(c.cast("timestamp"))
        elif self.kind == "date":
            c = F.unix_date(c)
        elif self.kind == "flag":
            c = c.cast("int")
        value = c.cast("double") + F.lit(0.0)          # one zero
        return F.when(F.isnan(value), F.lit(0.0)).otherwise(value)


def key_parts(df: DataFrame, keys: Sequence[str]) -> list[_Part]:
    """The numbers that order a table by its keys, nulls first and NaN last. One scan looks for those and the longest texts."""
    kinds = {k: df.schema[k].dataType for k in keys}
    exprs: dict = {}
    for k, kind in kinds.items():
        exprs[k, "null"] = F.count_if(col(k).isNull())
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            exprs[k, "nan"] = F.count_if(F.isnan(col(k)))
        if isinstance(kind, T.StringType):
            exprs[k, "text"] = F.max(F.octet_length(col(k)))
        if isinstance(kind, (T.LongType, T.DecimalType)):
            exprs[k, "rest"] = F.count_if(F.abs(col(k)) > (1 << 53)) if isinstance(kind, T.LongType) else F.count(col(k))
    seen = one_row(df, exprs)
    parts: list[_Part] = []
    for k, kind in kinds.items():
        parts += [_Part(k, flag) for flag in ("null", "nan") if seen.get((k, flag))]
        if isinstance(kind, T.StringType):
            parts += [_Part(k, "text", i) for i in range(math.ceil((seen[k, "text"] or 0) / CHUNK))]
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            parts.append(_Part(k, "time"))
        elif isinstance(kind, T.DateType):
            parts.append(_Part(k, "date"))
        elif isinstance(kind, T.BooleanType):
            parts.append(_Part(k, "flag"))
        elif isinstance(kind, T.NumericType):
            parts.append(_Part(k, "value"))
            parts += [_Part(k, "rest", getattr(kind, "scale", 0))] if seen.get((k, "rest")) else []
        else:
            raise ValueError(f"cannot cut a table by {k}: an order key is a number, a text, a date, a timestamp or a flag")
    return parts


@dataclass(frozen=True)
class _Cut:
    """Splits of one number for the buckets named by ``paths``, or for all rows at first."""

    part: _Part
    splits: tuple[float, ...]
    paths: tuple[str, ...] | None


@dataclass(frozen=True)
class OrderedBuckets:
    """Bounds that cut a table by its order keys into buckets of similar size.

    The first key is cut at sampled quantiles. Buckets that turn out too large are cut again among themselves, by the same
    number until they hold one value of it, then by the next, so a value that fills several buckets is cut by what
    orders its rows. A bucket is known by its places in all cuts, a struct that orders as the keys do. Rows with equal
    keys stay in one bucket.
    """

    cuts: tuple[_Cut, ...]

    @classmethod
    def fit(
        cls, df: DataFrame, keys: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET, rows: int | None = None,
    ) -> OrderedBuckets:
        rows = df.count() if rows is None else rows
        if rows <= rows_per_bucket:
            return cls(())
        keyed = df.select(*[col(k) for k in keys])
        parts = key_parts(keyed, keys)
        found = cls(())
        heavy = {"": (0, rows, None)} if parts else {}          # path: next number, rows, a value that is sure to divide it
        while heavy:
            at = min(part for part, _, _ in heavy.values())
            now = {path: v for path, v in heavy.items() if v[0] == at}
            wanted = math.ceil(sum(n for _, n, _ in now.values()) / rows_per_bucket)
            paths = tuple(now) if found.cuts else None
            tagged = found.tag(keyed)
            if paths is not None:
                tagged = tagged.where(_path(len(found.cuts)).isin(list(paths)))
            number = parts[at].number().alias("v")
            fraction = min(1.0, SAMPLED * wanted / sum(n for _, n, _ in now.values()))
            drawn = tagged.select(number)
            drawn = (drawn if fraction == 1.0 else drawn.sample(fraction, seed=5)).toArrow().column("v").to_numpy()
            drawn = np.sort(drawn)
            bounds = drawn[np.arange(1, wanted) * len(drawn) // wanted] if len(drawn) else drawn
            values, times = np.unique(bounds, return_counts=True)
            sure = [v for _, _, v in now.values() if v is not None]
            splits = sorted({*values.tolist(), *np.nextafter(values[times > 1], INF).tolist(), *sure} - {-INF, INF})
            found = cls((*found.cuts, _Cut(parts[at], tuple(splits), paths)))
            counted = found.tag(keyed)
            path = _path(len(found.cuts))
            if paths is not None:
                counted = counted.where(F.substring_index(path, ".", len(found.cuts) - 1).isin(list(paths)))
            left = counted.groupBy(path.alias("path")).agg(
                F.count("*").alias("n"), F.min(parts[at].number()).alias("lo"), F.max(parts[at].number()).alias("hi")
            ).where(F.col("n") > HEAVY * rows_per_bucket).collect()
            heavy = {f"{path}.0": v for path, v in heavy.items() if v[0] != at}
            for r in left:
                after = at + (r["lo"] == r["hi"])
                if after > at and parts[at].kind == "null" and r["hi"] == 0.0:       # nothing but nulls: no other part of the key differs
                    after = next((i for i in range(after, len(parts)) if parts[i].key != parts[at].key), len(parts))
                if after < len(parts):
                    heavy[r["path"]] = (after, r["n"], r["hi"] if after == at else None)
        return found

    @property
    def single(self) -> bool:
        return not self.cuts

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the bucket, a struct of whole numbers."""
        out = df
        for i, cut in enumerate(self.cuts):
            here = F.lit(True) if cut.paths is None else F.concat_ws(".", *[F.col(f"__b{j}") for j in range(i)]).isin(list(cut.paths))
            cutter = Bucketizer(splits=[-INF, *cut.splits, INF], inputCol="__v", outputCol=f"__b{i}")
            out = cutter.transform(out.withColumn("__v", F.coalesce(F.when(here, cut.part.number()), F.lit(-INF)))).withColumn(
                f"__b{i}", F.col(f"__b{i}").cast("bigint"))
        places = [F.col(f"__b{i}") for i in range(len(self.cuts))] or [F.lit(0).cast("bigint").alias("__b0")]
        return out.withColumn(BUCKET, F.struct(*places)).select(*[col(c) for c in df.columns], BUCKET)


def _path(cuts: int) -> Column:
    return F.concat_ws(".", *[F.col(f"{BUCKET}.__b{i}") for i in range(cuts)])


def fill(
    df: DataFrame, cols: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str] = (),
    direction: str = "forward", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Replace nulls by the nearest earlier (or later) non-null value in the given order, within each partition.

    Leading (trailing) nulls stay. Nulls of an order key come first. Rows that agree in all order keys are put in order by a
    hash of the row, so the result does not depend on partitioning, and any number of them is cut into buckets.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(f"unknown direction: {direction!r}")
    if not order_by:
        raise ValueError("a table has no row order: name the columns to order by")
    if not cols:
        return df
    forward = direction == "forward"
    every = [col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]
    tied = df.withColumn(TIE, F.xxhash64(*every, *[c.isNull() for c in every]))       # a hash passes over nulls
    buckets = OrderedBuckets.fit(tied, [*partition_by, *order_by, TIE], rows_per_bucket)
    tagged = buckets.tag(tied).withColumn(DATA, F.lit(True))
    if not buckets.single:
        tagged = _carries(tagged, cols, order_by, partition_by, forward).unionByName(tagged, allowMissingColumns=True)
    # Both directions run over the rows already seen; looking ahead would cost a pass per row. A carried row
    # (false) opens its bucket.
    local = Window.partitionBy(BUCKET, *[col(p) for p in partition_by]).orderBy(
        DATA, *_towards([*order_by, TIE], forward)).rowsBetween(Window.unboundedPreceding, 0)
    filled = tagged.withColumns({c: F.last(col(c), ignorenulls=True).over(local) for c in cols})
    return filled.where(DATA).select(*[col(c) for c in df.columns])


def _towards(names: Sequence[str], forward: bool) -> list[Column]:
    return [col(n).asc_nulls_first() if forward else col(n).desc_nulls_last() for n in names]


def _carries(
    tagged: DataFrame, cols: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str], forward: bool,
) -> DataFrame:
    """One row per bucket with the values that come in, from the buckets before it, for the partition it begins with.

    Partitions are the first order keys, so only the last of a bucket can go on in the next. The last values of the
    buckets are aggregated on the map side, for all columns in one scan, so the table itself is shuffled only once, by
    the window that fills it.
    """
    pick, edge = (F.max_by, F.min) if forward else (F.min_by, F.max)
    group = F.struct(*[col(p).alias(f"g{i}") for i, p in enumerate(partition_by)], F.lit(0).alias("g"))
    place = F.struct(group, *[col(k) for k in order_by], TIE)     # a struct is comparable even where a key in it is null
    tails = tagged.groupBy(BUCKET).agg(edge(group).alias("__edge"), *[
        pick(F.struct(group.alias("g"), col(c).alias("v")), F.when(col(c).isNotNull(), place)).alias(f"__tail{i}")
        for i, c in enumerate(cols)])
    past = Window.partitionBy(F.lit(0)).orderBy(*_towards([BUCKET], forward)).rowsBetween(Window.unboundedPreceding, -1)
    come = tails.select("__edge", BUCKET, *[F.last(f"__tail{i}", ignorenulls=True).over(past).alias(f"__tail{i}") for i in range(len(cols))])
    return come.select(
        *[F.col(f"__edge.g{i}").alias(p) for i, p in enumerate(partition_by)], BUCKET, F.lit(False).alias(DATA),
        *[F.when(F.col(f"__tail{i}.g").eqNullSafe(F.col("__edge")), F.col(f"__tail{i}.v")).alias(c) for i, c in enumerate(cols)])


def running_before(df: DataFrame, key: str, weights: Mapping[str, str], buckets: OrderedBuckets) -> DataFrame:
    """Add, by name, the total of each weight (a SQL expression) over all rows with a smaller key. The key must be unique."""
    held = {name: f"__w{i}" for i, name in enumerate(weights)}
    tagged = buckets.tag(df.withColumns({w: F.expr(weights[name]) for name, w in held.items()}))
    past = "rows between unbounded preceding and 1 preceding"
    local = tagged.withColumns({
        name: F.expr(f"coalesce(sum({w}) over (partition by {BUCKET} order by `{key}` {past}), 0L)") for name, w in held.items()})
    if not buckets.single:
        totals = tagged.groupBy(BUCKET).agg(*[F.sum(w).alias(w) for w in held.values()])
        offsets = totals.selectExpr(f"{BUCKET} as __b", *[
            f"coalesce(sum({w}) over (partition by 0 order by {BUCKET} {past}), 0L) as {w}o" for w in held.values()])
        local = local.join(F.broadcast(offsets), F.expr(f"{BUCKET} = __b"))       # one row per bucket
        local = local.withColumns({name: F.expr(f"`{name}` + {w}o") for name, w in held.items()})
    return local.drop(*held.values(), BUCKET, "__b", *[f"{w}o" for w in held.values()])
