"""Spelling variants: words one edit apart, found by one-edit neighbourhoods over a reduced alphabet."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import UPPER, name, written

RARE = 31                                # an occurrence whose hash this divides loses a letter
HELD_WORDS = 400_000                     # distinct words a task counts before it passes them on
BASE = 0x9E3779B97F4A7C15                # odd, so it can be divided by, modulo 2^64
SPREAD = 4.0                             # words that may share a word's reduced form, on the average of the words
MOST_SYMBOLS = 60
LETTERS = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
ENTRIES = 2_000_000                      # neighbours that are worked out at a time, at least those of one word


def _byte_table() -> bytes:
    """Small letters for A-Z, the letters themselves, and a space for every other byte of Latin-1."""
    out = bytearray(b" " * 256)
    for letter in LETTERS:
        out[ord(letter)] = ord(letter)
    for letter in UPPER:
        out[ord(letter)] = ord(letter) + 32
    return bytes(out)


def _count(least: int):
    table = _byte_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held]), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                # one byte per code point; whatever Latin-1 lacks is no letter here
                runs = (text.as_py() or "").encode("latin-1", "replace").translate(table).split()
                start = zlib.crc32(f"{key.as_py() or ''}:".encode())
                for word, n in Counter([w for w in runs if len(w) >= least]).items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if h % RARE == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    return run


def vocabulary(docs: DataFrame, key: str = "doc_id", least: int = 7) -> DataFrame:
    """``word``, ``n``: the words of at least ``least`` letters that occur twice or more, over all documents."""
    rows = docs.select(F.coalesce(name(key).cast("string"), F.lit("")).alias("key"), name("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_count(least), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter("n >= 2")


def alphabet(words: DataFrame, symbols: int) -> str:
    """A symbol for each letter, in the order of ``LETTERS``: letters by falling frequency, each to the lightest symbol.

    Symbols are characters from code 1 on. The counts are one number per letter.
    """
    parts = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count("*").alias("n"))
    counts = {r["letter"]: r["n"] for r in parts.filter(F.col("letter").isin(LETTERS)).collect()}
    load, out = [0] * symbols, {}
    for letter in sorted(LETTERS, key=lambda c: (-counts.get(c, 0), c)):
        at = min(range(symbols), key=lambda i: (load[i], i))
        load[at] += counts.get(letter, 0)
        out[letter] = chr(at + 1)
    return "".join(out[c] for c in LETTERS)


def reduced_form(word: str, chosen: str):
    return F.translate(word, "".join(LETTERS), chosen)


def _alphabet(words: DataFrame, total: int) -> str:
    """The smallest alphabet, from one in which words of eight letters outnumber the vocabulary, that keeps groups small."""
    symbols = 4
    while symbols ** 8 < total:
        symbols += 1
    while True:
        chosen = alphabet(words, symbols)
        if symbols >= MOST_SYMBOLS:
            return chosen
        groups = words.groupBy(reduced_form("word", chosen)).agg(F.count("*").alias("c"))
        if (groups.agg(F.sum(F.col("c") * F.col("c"))).first()[0] or 0) <= SPREAD * total:
            return chosen
        symbols += max(2, symbols // 2)


def _powers(length: int) -> np.ndarray:
    return np.array([pow(BASE, i, 1 << 64) for i in range(length + 2)], np.uint64)


def neighbourhood(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of some reduced words of one length, and those of all their one-edit neighbours, a row each.

    A word is a polynomial in an odd base modulo 2^64, symbols counted from 1, so the hash of a neighbour follows from
    those of the word's beginnings and ends.
    """
    count, length = symbols.shape
    s, power = symbols.astype(np.uint64), _powers(length)
    inverse = np.uint64(pow(BASE, -1, 1 << 64))
    terms = s * power[:length]
    before = np.concatenate([np.zeros((count, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)
    own = before[:, -1]
    after = own[:, None] - before
    kinds = np.arange(1, size + 1, dtype=np.uint64)
    deleted = before[:, :-1] + after[:, 1:] * inverse
    replaced = (own[:, None] - terms)[:, :, None] + kinds * power[:length, None]
    inserted = (before + after * np.uint64(BASE))[:, :, None] + kinds * power[:length + 1, None]
    return own, np.concatenate([deleted, replaced.reshape(count, -1), inserted.reshape(count, -1)], axis=1)


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places and symbols of the reduced words of a batch, length by length."""
    raw = [w.encode("latin-1") for w in batch.column(column).to_pylist()]
    sizes = np.array([len(w) for w in raw], np.int64)
    for length in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == length)
        yield rows, np.frombuffer(b"".join([raw[i] for i in rows]), np.uint8).reshape(len(rows), length)


def _own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.empty(batch.num_rows, np.uint64)
        for rows, symbols in _by_length(batch, "reduced"):
            keys[rows] = (symbols.astype(np.uint64) * _powers(symbols.shape[1])[:symbols.shape[1]]).sum(axis=1, dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), batch.column("reduced"), pa.array(keys.view(np.int64))],
            ["word", "n", "reduced", "at"])


def _neighbours(size: int):
    """Rows of a reduced word and a neighbour that is not smaller, itself included: each pair from one side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, symbols in _by_length(batch, "reduced"):
                step = max(1, ENTRIES // ((2 * size + 1) * (symbols.shape[1] + 1)))
                for start in range(0, len(symbols), step):
                    own, near = neighbourhood(symbols[start:start + step], size)
                    near = np.sort(np.concatenate([near, own[:, None]], axis=1), axis=1)
                    wanted = near >= own[:, None]
                    wanted[:, 1:] &= near[:, 1:] != near[:, :-1]
                    where = np.nonzero(wanted)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[where[0]].view(np.int64)), pa.array(near[where].view(np.int64))], ["own", "at"])

    return run


def near_words(words: DataFrame, total: int) -> DataFrame:
    """``word``, ``other``, ``n``, ``other_n`` for every two words one edit apart, each pair once."""
    chosen = _alphabet(words, total)
    size = len(set(chosen))
    reduced = words.select("word", "n", reduced_form("word", chosen).alias("reduced"))
    keyed = written(reduced.mapInArrow(_own_keys, "word string, n bigint, reduced string, at bigint"))
    forms = keyed.select("reduced").distinct()
    around = forms.mapInArrow(_neighbours(size), "own bigint, at bigint")
    known = keyed.select("at").distinct()
    met = around.join(known.hint("shuffle_hash"), "at", "left_semi").dropDuplicates(["at", "own"])
    left = keyed.select(F.col("at").alias("own"), "word", "n")
    right = keyed.select("at", F.col("word").alias("other"), F.col("n").alias("other_n"))
    both = met.join(left, "own").join(right, "at")
    return both.filter(
        ((F.col("own") != F.col("at")) | (F.col("word") < F.col("other")))
        & (F.abs(F.char_length("word") - F.char_length("other")) <= 1)
        & (F.levenshtein("word", "other", 1) == 1)).select("word", "other", "n", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of forms, by doubling. A form occurs ten times as often as its word, so
    chains are short and have no rings."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("__word"), F.col("root").alias("__next"))
        step = now.join(on, F.col("root") == F.col("__word"), "left")
        after = written(step.select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")))
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variant_groups(docs: DataFrame, key: str = "doc_id", least: int = 7, ratio: int = 10) -> DataFrame:
    """Per word ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z made small, of all whole texts. Where 31
    divides the crc32 of ``<key>:<run>`` the run loses the letter the hash points at. Words of ``least`` letters that
    occur twice or more are kept. Words are near if one inserted, deleted or replaced letter parts them; a word's form is
    its most frequent near word, of ties the first in code-point order, if that occurs ``ratio`` times as often; its
    root is the last of the chain of forms.

    Letters are mapped to a few symbols, so many that the reduced words stay apart (the number grows with the vocabulary
    and changes no result). The full one-edit neighbourhood of each reduced word, over the symbols, is joined with the
    reduced vocabulary by a 64-bit hash; what meets is held against the original words. Every two words one edit apart
    have reduced words at most one edit apart, so none is missed. Only the vocabulary is shuffled, never the texts.

    Null and empty texts have no words, a null key counts as an empty text, repeated rows count each, and a table
    without words gives no rows. Only the key and ``text`` are read.
    """
    words = written(vocabulary(docs, key, least))
    total = words.count()
    pairs = near_words(words, max(total, 1))
    side = lambda a, b, n: F.struct(F.col(a).alias("word"), (-F.col(n)).alias("less"), F.col(b).alias("other"))
    sides = pairs.select(F.inline(F.array(side("word", "other", "other_n"), side("other", "word", "n"))))
    best = written(sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("less", "other")).alias("best")))
    best = best.withColumnRenamed("word", "__word")
    found = written(words.join(best, F.col("word") == F.col("__word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("top"))
        .select("word", "n", "n_near", "top.form", "top.form_n"))
    roots = _roots(found.filter("form is not null")).select(F.col("word").alias("__word"), "root")
    return found.join(roots, F.col("word") == F.col("__word"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
