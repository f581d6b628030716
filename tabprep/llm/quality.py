"""Quality rules: base counts, and Jensen-Shannon distance of a document to the profile of its language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import body, checkpointed, let, name, with_lookup, words

COMMON = 12                              # words in the profile of a language
CHAR_LIMIT, WORD_LIMIT = 0.20, 0.30      # distances above which a document is rejected
MIN_CHARS, MIN_WORDS = 200, 100          # shorter documents are not judged by that histogram
MIN_PROFILE_WORDS = 2000                 # smaller languages have no profile and reject nothing
CLASSES = ("small", "upper", "digit", "space", "symbol", "mark", "other")


def _class_counts(text: Column, spaces: Column) -> Column:
    """Characters per class, given the number of white-space characters.

    One pass takes out small letters and white space in long runs; the other classes are told apart in the rest.
    """
    def rest(left: Column) -> Column:
        def without(pattern: str) -> Column:
            return F.char_length(F.regexp_replace(left, pattern, ""))
        n = F.char_length(left)
        upper, digit, symbol, mark = [n - without(p) for p in ("[A-Z]+", "[0-9]+", "[#*$%&|<>]+", "[!\"'()+,./:;=?@\\[\\]^_`{}~\\\\-]+")]
        return F.array(F.char_length(text) - spaces - n, upper, digit, spaces, symbol, mark, n - upper - digit - symbol - mark)

    return let(F.regexp_replace(text, "[a-z\\x20\\x09-\\x0D]+", ""), rest)


def _spaces(text: Column, word: Column) -> Column:
    return F.char_length(text) - F.char_length(F.array_join(word, ""))


def _repeat_words(word: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    A window is one number, its hash in the high part and its place in the low part, so a sort of plain numbers
    brings equal windows together. The hash keeps 63 bits less those of the place.
    """
    n = F.size(word).cast("bigint")

    def packed(half: Column, at: Column) -> Column:
        return half - F.pmod(half, n) + at

    def places(sorted_: Column) -> Column:
        def again(value: Column, i: Column) -> Column:
            own = value - F.pmod(value, n)
            before, after = F.get(sorted_, i - 1), F.get(sorted_, i + 1)
            return F.coalesce(own == before - F.pmod(before, n), F.lit(False)) | F.coalesce(
                own == after - F.pmod(after, n), F.lit(False))
        return F.sort_array(F.transform(F.filter(sorted_, again), lambda v: F.pmod(v, n)))

    def covered(place: Column) -> Column:
        gaps = F.transform(place, lambda v, i: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get(place, i + 1) - v, F.lit(3).cast("bigint"))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b)

    def unless_distinct(hashes: Column) -> Column:
        found = let(let(F.sort_array(F.transform(hashes, packed)), places), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(found)

    windows = F.transform(F.slice(word, F.lit(1), F.greatest(F.size(word) - 2, F.lit(0))), lambda w, i: F.shiftright(
        F.xxhash64(w, F.get(word, i + 1), F.get(word, i + 2)), 1))
    return let(windows, unless_distinct)


def _distance(own: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of shares."""
    def part(p: Column, q: Column) -> Column:
        one = F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))
        two = F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(F.lit(0.0))
        return (one + two) / 2
    total = F.aggregate(F.zip_with(own, reference, part), F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(F.round(total, 12), F.lit(0.0)))


def profiles(docs: DataFrame) -> DataFrame:
    """Per language: shares of the character classes, its most common words and their shares with the rest last.

    Everything is counted over all documents. Words are counted in the map tasks first; of each language the first
    12 words by count, then by text, are kept.
    """
    text = body()
    chars = (
        docs.select("lang", _class_counts(text, _spaces(text, words(text))).alias("c"))
        .groupBy("lang").agg(*[F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]))
    every = sum((F.col(f"c{i}") for i in range(1, len(CLASSES))), F.col("c0"))
    chars = chars.select("lang", F.array(*[F.col(f"c{i}") / F.greatest(every, F.lit(1)) for i in range(len(CLASSES))]).alias("char_shares"))
    counted = docs.select("lang", F.explode_outer(words(text)).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    counted = counted.filter("word is not null")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    first = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    top = (
        counted.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= COMMON)
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("r", "word", "n"))).alias("top")))
    same = lambda a, b: F.col(f"{a}.lang").eqNullSafe(F.col(f"{b}.lang"))
    shares = F.transform("top.n", lambda n: n / F.col("total"))
    rest = 1 - F.aggregate("top.n", F.lit(0).cast("bigint"), lambda a, b: a + b) / F.col("total")
    return (
        chars.alias("a").join(totals.alias("b"), same("a", "b")).join(top.alias("c"), same("a", "c"))
        .filter(F.col("total") >= MIN_PROFILE_WORDS)
        .select("a.lang", F.col("char_shares").alias("__char_shares"), F.col("top.word").alias("__common"),
                F.concat(shares, F.array(rest)).alias("__word_shares")))


def judge(docs: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """The documents with the base counts, ``char_distance``, ``word_distance``, ``base_failed`` and ``kept``.

    Everything about a document is worked out in its row: no shuffle, whatever its length. A document is rejected
    if the base rule fails, or if the distance of its character classes or of its common words to the profile of
    its language is above the limit, which for words is at most nine tenths of what a text without them has. Documents below the length guards are not judged by that histogram (their
    distance is null), nor are those whose language, null being one, has no profile. Null texts count as empty and
    fail the base rule. Columns of these names are replaced, all others kept.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance", "word_distance", "base_failed", "kept")
    kept = docs.drop(*made)
    known = checkpointed(profiles(kept)) if references is None else references
    text = body()
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    # a generated row: were these plain columns, a later filter would repeat the split for every word of the text
    pieces = F.inline_outer(F.array(F.struct(words(text).alias("__words"), lines.alias("__lines"))))
    counted = (
        kept.select(*[name(c) for c in kept.columns], pieces)
        .withColumn("__classes", _class_counts(text, _spaces(text, F.col("__words"))))
        .withColumns({
            "n_words": F.size("__words").cast("bigint"), "__chars": F.aggregate("__classes", F.lit(0), lambda a, b: a + b),
            "n_symbols": F.get("__classes", F.lit(4)).cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": _repeat_words(F.col("__words"))}))
    joined = with_lookup(counted, known, "lang", F.xxhash64(text))
    own_chars = F.transform("__classes", lambda c: c / F.col("__chars"))
    hits = F.transform("__common", lambda w: F.size("__words") - F.size(F.array_remove(F.col("__words"), w)))
    own_words = let(hits, lambda h: F.concat(
        F.transform(h, lambda c: c / F.col("n_words")),
        F.array(1 - F.aggregate(h, F.lit(0), lambda a, b: a + b) / F.col("n_words"))))
    char_distance = F.when((F.col("__chars") >= MIN_CHARS) & F.col("__char_shares").isNotNull(), _distance(own_chars, F.col("__char_shares")))
    word_distance = F.when((F.col("n_words") >= MIN_WORDS) & F.col("__common").isNotNull(), _distance(own_words, F.col("__word_shares")))
    judged = joined.withColumns({
        "word_chars": (F.col("__chars") - F.get("__classes", F.lit(3))).cast("bigint"),
        "char_distance": char_distance, "word_distance": word_distance,
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))})
    # a text with none of the common words is rejected in every language, however little of it they cover
    none = F.transform("__word_shares", lambda x, i: (i == F.size("__word_shares") - 1).cast("double"))
    limit = F.least(F.lit(WORD_LIMIT), 0.9 * _distance(none, F.col("__word_shares")))
    near = F.coalesce(F.col("char_distance") <= CHAR_LIMIT, F.lit(True)) & F.coalesce(F.col("word_distance") <= limit, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & near).select(*[name(c) for c in kept.columns], *made)
