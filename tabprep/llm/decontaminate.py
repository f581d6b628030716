"""Benchmark decontamination by winnowed k-gram fingerprints, joined and extended to the shared span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import BROADCAST_BYTES, body, let, lower_ascii, name, words

SPAN, GRAM = 10, 7                       # words of a window and of a fingerprint
WINNOW = SPAN - GRAM + 1                 # fingerprints to choose from: every span of SPAN words keeps at least one
REACH = SPAN - GRAM                      # words on either side that a window around a fingerprint may take in
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def benchmark_words(text: Column) -> Column:
    return words(lower_ascii(body(text)), GAP)


def _gram_hash(array: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(array, at + i) for i in range(length)])


def _starts(array: Column, length: int) -> Column:
    """0 .. last start of a run of that length; empty if there is none."""
    last = F.size(array) - length
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _least(hashes: Column, at: Column) -> Column:
    """The place of the least of the hashes of a window, the last of equals."""
    def choose(value: Column) -> Column:
        low = F.array_min(value)
        out = F.lit(0)
        for i in range(1, WINNOW):
            out = F.when(F.get(value, F.lit(i)) == low, F.lit(i)).otherwise(out)
        return at + out

    return let(F.slice(hashes, at + 1, F.lit(WINNOW)), choose)


def _prints(array: Column, short: list[int], whole: bool) -> Column:
    """Fingerprints (length, start, hash): winnowed k-grams, and every run of the lengths in ``short``.

    ``whole`` keeps runs of such a length only where they are the whole text.
    """
    def winnowed(hashes: Column) -> Column:
        places = F.array_distinct(F.transform(_starts(hashes, WINNOW), lambda at: _least(hashes, at)))
        return F.transform(places, lambda at: F.struct(
            F.lit(GRAM).alias("length"), at.alias("start"), F.get(hashes, at).alias("hash")))

    out = [let(F.transform(_starts(array, GRAM), lambda at: _gram_hash(array, at, GRAM)), winnowed)]
    def runs_of(n: int) -> Column:
        return F.transform(_starts(array, n), lambda at: F.struct(
            F.lit(-n).alias("length"), at.alias("start"), _gram_hash(array, at, n).alias("hash")))

    for n in short:
        runs = runs_of(n)
        out.append(F.when(F.size(array) == n, runs).otherwise(F.slice(runs, 1, 0)) if whole else runs)
    return F.concat(*out) if len(out) > 1 else out[0]


def _around(array: str) -> Column:
    """The words of a fingerprint and those a window may add on either side; null beyond the text."""
    start = F.col("__print.start")
    reach = [F.get(F.col(array), start + i) for i in range(-REACH, GRAM + REACH)]
    return F.array(*reach)


def _matched() -> tuple[Column, Column, Column]:
    """Whether the fingerprint's own words are equal, and how many more are on its left and right."""
    def equal(i: int) -> Column:
        at = i + REACH
        return F.coalesce(F.get("__here", F.lit(at)) == F.get("__there", F.lit(at)), F.lit(False))

    length = F.abs(F.col("__len"))
    core = F.lit(True)
    for i in range(SPAN - 1):
        core = core & (equal(i) | (length <= i))
    left, right = F.lit(0), F.lit(0)
    for i in range(REACH, 0, -1):
        left = F.when(equal(-i), left + 1).otherwise(F.lit(0)) if i < REACH else equal(-i).cast("int")
        right = F.when(equal(GRAM - 1 + i), right + 1).otherwise(F.lit(0)) if i < REACH else equal(GRAM - 1 + i).cast("int")
    return core, left, right


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The documents with ``n_words``, ``n_hit``, ``items`` (sorted ids as text) and ``contaminated``.

    A hit is a document word inside an occurrence of ten consecutive words of an item, or of a whole item that is
    shorter. Both sides keep the least of every four neighbouring 7-gram hashes, so a shared run of ten words
    shares a kept hash at the same place. Kept hashes are joined, their words compared, and the match extended by
    up to three words a side; ten words in all make a hit, and longer spans are the union of such hits. Items of
    fewer words are looked for whole, by a hash of their length. Item fingerprints with equal surroundings are
    one row with a list of items, and are broadcast only when measured below ``max_bytes``; beyond it, the join
    is a shuffle whose large keys adaptive execution splits.

    Null and empty texts have no words and no hits. Rows that repeat a key and text are hit alike; null keys and
    null item ids are values. Empty tables are allowed on both sides. Columns of the documents are kept, those
    with the names above are replaced.
    """
    made = "n_words", "n_hit", "items", "contaminated"
    items = benchmark.select(
        name(item).cast("string").alias("__item"), benchmark_words(name("text")).alias("__words"))
    lengths = items.select(F.size("__words").alias("n")).filter(f"n between 1 and {SPAN - 1}").distinct()
    short = sorted(r["n"] for r in lengths.collect())                       # at most nine numbers
    known = (
        items.withColumn("__prints", _prints(F.col("__words"), short, whole=True))
        .select("__item", "__words", F.explode_outer("__prints").alias("__print"))
        .select(F.col("__print.length").alias("__l"), F.col("__print.hash").alias("__h"),
                _around("__words").alias("__there"), "__item")
        .groupBy("__l", "__h", "__there").agg(F.collect_set(F.coalesce("__item", F.lit("null"))).alias("__items")))
    size = known.agg(F.sum(F.octet_length(F.to_json(F.struct("__there", "__items"))) + 64)).first()[0] or 0
    known = F.broadcast(known) if size <= max_bytes else known

    kept = docs.drop(*made)
    text = body()
    tokens = kept.select(
        name(key).alias("__key"), F.xxhash64(text).alias("__text"), benchmark_words(text).alias("__words"))
    # explode_outer: a plain explode infers a filter that would compute all fingerprints a second time
    hits = (
        tokens.withColumn("__prints", _prints(F.col("__words"), short, whole=False))
        .select("__key", "__text", "__words", F.explode_outer("__prints").alias("__print"))
        .join(known, (F.col("__print.hash") == F.col("__h")) & (F.col("__print.length") == F.col("__l")))
        .select("__key", "__text", F.col("__print.start").alias("__start"), F.col("__l").alias("__len"),
                _around("__words").alias("__here"), "__there", "__items"))
    core, left, right = _matched()
    long = F.col("__len") > 0
    spans = (
        hits.select("__key", "__text", "__items", "__start", "__len", core.alias("__core"), left.alias("__left"), right.alias("__right"))
        .filter(F.col("__core") & (~long | (F.col("__left") + F.col("__right") >= REACH)))
        .select(
            "__key", "__text", "__items",
            F.when(long, F.col("__start") - F.col("__left")).otherwise(F.col("__start")).alias("__from"),
            F.when(long, F.col("__start") + F.col("__len") + F.col("__right")).otherwise(F.col("__start") - F.col("__len")).alias("__to")))
    found = spans.groupBy("__key", "__text").agg(
        F.size(F.array_distinct(F.flatten(F.transform(
            F.collect_set(F.struct("__from", "__to")), lambda s: F.sequence(s["__from"], s["__to"] - 1))))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("__items")))).alias("items")
    ).withColumnsRenamed({"__key": "__k", "__text": "__t"})
    same = name(key).eqNullSafe(F.col("__k")) & (F.xxhash64(text) == F.col("__t"))
    return kept.join(found, same, "left").select(
        *[name(c) for c in kept.columns],
        F.size(benchmark_words(text)).cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
