"""Language of texts: sparse multinomial regression on character n-grams, follow-the-regularised-leader, calibrated."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import checkpointed, name

BITS = 16                                # character n-grams are told apart by a hash of so many bits
ORDERS = 3                               # n-grams of one to so many characters
PER_LANGUAGE = 3_000                     # labelled documents of a language that the weights are fitted on, about
MAX_LANGUAGES = 100
PARTS, ROUNDS = 8, 3                     # of the bounded sample
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
SNIPPET = 60                             # characters of the short piece that every document is also learnt from
HELD = 5                                 # one sampled document in so many calibrates the temperature
TEMPERATURES = np.exp(np.linspace(np.log(0.02), np.log(20.0), 139))
BLOCK = 1 << 20                          # characters of a text that are hashed at a time
UNKNOWN = "und"
P1, P2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def folding() -> np.ndarray:
    """Per code point the code of its small letter, or a space for whatever is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (c := chr(code)).isalpha():
            table[code] = ord(c.lower()[0])
    return table


class Features:
    """Counts of hashed character n-grams of a text's letters; a run of anything else is one space."""

    def __init__(self):
        self.fold = folding()

    def _codes(self, block: str) -> np.ndarray:
        codes = self.fold[np.frombuffer(block.encode("utf-32-le", "replace"), np.uint32)]
        gap = codes == 32
        return codes[~(gap & np.concatenate(([False], gap[:-1])))]

    def counts(self, text: str | None) -> np.ndarray | None:
        """Counts per n-gram code, or None where there is no letter. Long texts are taken block by block."""
        total, tail, letters = None, np.array([32], np.uint32), False
        for at in range(0, len(text or ""), BLOCK):
            codes = self._codes(text[at:at + BLOCK])
            letters = letters or bool((codes != 32).any())
            if len(tail) and tail[-1] == 32 and codes[0] == 32:
                codes = codes[1:]
            if at + BLOCK >= len(text) and (not len(codes) or codes[-1] != 32):
                codes = np.append(codes, np.uint32(32))
            joined = np.concatenate((tail, codes))
            part = self._block(joined, len(tail))
            total = part if total is None else total + part
            tail = joined[-(ORDERS - 1):]
        return total if letters else None

    @staticmethod
    def _block(codes: np.ndarray, known: int) -> np.ndarray:
        """Counts of the n-grams that end behind the first ``known`` codes."""
        out, h = np.zeros(1 << BITS, np.int64), np.zeros(len(codes), np.uint32)
        for n in range(ORDERS):
            h = (codes if not n else h[:-1] * P1 + codes[n:] * P2 + np.uint32(n)).astype(np.uint32)
            late = h[max(known - n, 0):]
            mixed = (late ^ (late >> np.uint32(15))) * P2
            out += np.bincount(((mixed ^ (mixed >> np.uint32(13))) * P1) >> np.uint32(32 - BITS), minlength=1 << BITS)
        return out

    def vector(self, text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Places and values of the text's unit TF-IDF vector, term counts on a log scale."""
        counts = self.counts(text)
        if counts is None:
            return None
        places = np.flatnonzero(counts)
        values = (1 + np.log(counts[places])) * idf[places]
        return places, values / max(float(np.sqrt(values @ values)), 1e-12)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, held, n = Features(), np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            counts = features.counts(text.as_py())
            if counts is not None:
                held += counts > 0
                n += 1
    seen = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(held[seen], n))], ["place", "n"])


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


@dataclass
class Leader:
    """The state of follow-the-regularised-leader: gradient sums corrected by past steps, and sums of squares.

    The last row is the intercept, which no penalty shrinks. Weights follow from the state in closed form; the
    absolute penalty makes those of weak features exactly zero.
    """

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def fresh(cls, classes: int) -> Leader:
        return cls(np.zeros(((1 << BITS) + 1, classes)), np.zeros(((1 << BITS) + 1, classes)))

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Weights of some rows, of which the last must be the intercept's."""
        z, n = self.z[rows], self.n[rows]
        l1, l2 = np.full((len(z), 1), L1), np.full((len(z), 1), L2)
        l1[-1], l2[-1] = 0.0, 0.0
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0.0) / ((BETA + np.sqrt(n)) / ALPHA + l2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        rows, x = np.append(places, len(self.z) - 1), np.append(values, 1.0)
        w = self.weights(rows)
        p = softmax(x @ w)
        p[label] -= 1.0
        g = x[:, None] * p
        more = self.n[rows] + g * g
        self.z[rows] += g - (np.sqrt(more) - np.sqrt(self.n[rows])) / ALPHA * w
        self.n[rows] = more


def _pieces(text: str, mark: int) -> list[str]:
    """The whole text and, of a longer one, a short piece at a place its mark chooses."""
    if len(text) <= 2 * SNIPPET:
        return [text]
    at = mark % (len(text) - SNIPPET)
    return [text, text[at:at + SNIPPET]]


def _train(state: Leader, idf: np.ndarray, codes: dict[str, int]):
    """Local rounds over the documents of a part; what the part adds to the state, by the rows it touched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, local, any_ = Features(), Leader(state.z.copy(), state.n.copy()), False
        for batch in batches:
            for text, lang, mark in zip(*[batch.column(c).to_pylist() for c in ("text", "lang", "mark")]):
                for piece in _pieces(text or "", mark & ((1 << 40) - 1)):
                    if (found := features.vector(piece, idf)) is not None:
                        local.learn(*found, codes[lang])
                        any_ = True
        if any_:
            z, n = local.z - state.z, local.n - state.n
            rows = np.flatnonzero(n.any(axis=1))
            as_list = lambda a: pa.array(a[rows].tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(rows), as_list(z), as_list(n)], ["row", "z", "n"])

    return run


def _fit(sample: DataFrame, idf: np.ndarray, codes: dict[str, int]) -> Leader:
    """Rounds over the parts. Each starts from the common state, to which the mean of what the parts add to it is added."""
    state = Leader.fresh(len(codes))
    for turn in range(ROUNDS):
        order = sample.repartition(PARTS, F.xxhash64("mark", F.lit(turn))).sortWithinPartitions(F.xxhash64("mark", F.lit(turn)))
        places = [F.posexplode(F.arrays_zip("z", "n")).alias("class", "v")]
        got = (order.mapInArrow(_train(state, idf, codes), "row bigint, z array<double>, n array<double>")
               .select("row", *places).groupBy("row", "class")
               .agg(F.avg("v.z").alias("z"), F.avg("v.n").alias("n")).toArrow())
        rows, cells = got.column("row").to_numpy(), got.column("class").to_numpy()
        state.z[rows, cells] += got.column("z").to_numpy()
        state.n[rows, cells] += got.column("n").to_numpy()
    return state


class Classifier:
    """The weights that are not zero, with the intercept last."""

    def __init__(self, weights: np.ndarray, idf: np.ndarray, languages: list[str]):
        self.rows = np.flatnonzero(weights[:-1].any(axis=1))
        self.some, self.intercept = weights[self.rows].astype(np.float32), weights[-1]
        self.idf, self.languages = idf.astype(np.float32), languages

    def dense(self) -> np.ndarray:
        out = np.zeros((1 << BITS, len(self.languages)), np.float32)
        out[self.rows] = self.some
        return out

    def logits(self, found: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> np.ndarray:
        places, values = found
        return values @ weights[places] + self.intercept


def _losses(model: Classifier, codes: dict[str, int]):
    """Sums of the log loss of a part's documents at every temperature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, total = Features(), model.dense(), np.zeros(len(TEMPERATURES))
        for batch in batches:
            for text, lang, mark in zip(*[batch.column(c).to_pylist() for c in ("text", "lang", "mark")]):
                for piece in _pieces(text or "", mark & ((1 << 40) - 1)):
                    if (found := features.vector(piece, model.idf)) is not None:
                        logits = model.logits(found, weights)[None, :] / TEMPERATURES[:, None]
                        total -= np.log(np.maximum(softmax(logits)[:, codes[lang]], 1e-12))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total))), pa.array(total)], ["at", "loss"])

    return run


def _temperature(sample: DataFrame, model: Classifier, codes: dict[str, int]) -> float:
    """The temperature of least log loss on documents the weights have not seen."""
    got = sample.mapInArrow(_losses(model, codes), "at bigint, loss double").groupBy("at").agg(F.sum("loss").alias("loss")).collect()
    losses = np.zeros(len(TEMPERATURES))
    for at, loss in got:
        losses[at] = loss
    return float(TEMPERATURES[losses.argmin()]) if losses.any() else 1.0


def _predict(model: Classifier, temperature: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights = Features(), model.dense()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, langs, scores = batch.slice(at, 512), [], []
                for text in part.column("text"):
                    found = features.vector(text.as_py(), model.idf) if model.languages else None
                    if found is None:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    p = softmax(model.logits(found, weights) / temperature)
                    langs.append(model.languages[int(p.argmax())])
                    scores.append(float(p.max()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    ["key", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, key: str = "doc_id", lang: str = "lang", train: Column | None = None,
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per row: key, ``held_out``, ``lang_pred``, ``score`` (the calibrated probability of the prediction).

    A text becomes the unit TF-IDF vector of its character n-grams (one to three letters, small, runs of other characters
    one space), hashed to 16 bits. How many documents hold an n-gram is counted over all rows that ``train`` marks
    (default: all but those whose crc32 of the key leaves 2 by 4). About ``per_language`` of the labelled ones of each
    language, chosen by hash, are what the weights are fitted on, by follow-the-regularised-leader with an absolute and
    a squared penalty: eight parts learn from a common state, the mean of what they add is the next round's. One
    chosen document in five is kept back for the temperature that its log loss is least at.

    Null texts and texts without a letter give ``und`` and score 0, as does everything if nothing is labelled. A null key
    counts as an empty text; rows that repeat a key or a text are predicted alike, each for itself. Of equal scores
    the language first in code-point order wins. Long texts are counted in blocks, whole. An empty table gives an
    empty table. More than 100 languages are an error. Only the key, ``text`` and the language are read.
    """
    code = F.crc32(F.coalesce(name(key).cast("string"), F.lit("")).cast("binary"))
    chosen = F.coalesce(train, F.lit(False)) if train is not None else code % 4 != 2
    rows = docs.select(name(key).alias("key"), chosen.alias("train"), name("text").cast("string").alias("text"), name(lang).cast("string").alias("lang"))
    learnt = rows.filter(F.col("train") & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in learnt.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled: does {lang} hold languages?")
    languages = sorted(sizes)
    codes = {v: i for i, v in enumerate(languages)}
    model, temperature = Classifier(np.zeros((1, 0)), np.zeros(0), []), 1.0
    if languages:
        counted = learnt.select("text").mapInArrow(_document_counts, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
        places, n = counted.column("place").to_numpy(), counted.column("n").to_numpy()
        frequency = np.zeros(1 << BITS)
        frequency[places[places >= 0]] = n[places >= 0]
        idf = np.log((1.0 + n[places < 0].sum()) / (1.0 + frequency)) + 1.0
        share = F.lit(0.0)
        for value in languages:
            share = F.when(F.col("lang") == value, F.lit(min(1.0, per_language / sizes[value]))).otherwise(share)
        mark = F.xxhash64("key", F.coalesce("text", F.lit("")))
        drawn = F.pmod(F.xxhash64(mark, F.lit(7)), F.lit(1 << 30)) < share * (1 << 30)
        sample = checkpointed(learnt.select("text", "lang", mark.alias("mark")).filter(drawn))
        held = F.pmod(F.xxhash64("mark", F.lit(11)), F.lit(HELD)) == 0
        model = Classifier(_fit(sample.filter(~held), idf, codes).weights(), idf, languages)
        temperature = _temperature(sample.filter(held), model, codes)
    out = f"key {docs.schema[key].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return rows.select("key", (~F.col("train")).alias("held_out"), "text").mapInArrow(_predict(model, temperature), out).withColumnRenamed("key", key)
