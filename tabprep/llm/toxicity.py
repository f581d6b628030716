"""Toxicity by Levenshtein automata over a lexicon trie, with the context of each hit."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import BROADCAST_BYTES, name

MAX_LABELLED = 20_000                    # labelled documents that fit the lexicon and the weights, drawn by hash
MAX_TERMS = 2_000                        # learnt terms
MIN_STEM, MAX_STEM = 4, 12               # letters of a learnt stem
MIN_FUZZY = 5                            # letters of a term that may be misspelled by one edit; twice that by two
LONG_HEAD = 2 * MIN_FUZZY - 2            # letters that a misspelling by two edits has at least
CONTEXT = 60                             # characters on either side of a hit
CACHE_WORDS = 500_000
WORD = re.compile(r"[^\W_]+")
# Terms known without labels, marks and verbs of quotation, and words that address a reader.
SEED_TERMS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown")
QUOTES = "\"'“”„‚‘’«»‹›"
SAYING = re.compile(r"\b(said|says|wrote|called|quote[sd]?|word|term|sagte|schrieb|nannte|wort|dit|écrit|appelé|mot|dijo|escribió|llamó|palabra)\b")
ADDRESS = re.compile(r"\b(you|your|you're|du|dich|dein|ihr|tu|toi|vous|votre|usted|eres|tú)\b")
N_FEATURES = 10


class Trie:
    """Terms and stems as nested dicts. ``search`` runs the Levenshtein automaton of a word along the branches that share
    a shortened head with it, and follows them only while some state is within the allowed edits.

    With k edits, swaps of neighbours included, each edit costs at most one common letter of the first letters of a
    term and of a word: both heads are equal after exactly k letters are taken out of each. So no term and no stem
    within reach is passed over. Heads have all letters of a term of one edit, and 8 of one of two.
    """

    def __init__(self, terms: dict[str, float]):
        self.terms, self.root, self.longest = terms, {}, 0
        self.heads: tuple[dict[str, list], dict[str, list]] = ({}, {})       # of one edit and of two
        for term, weight in terms.items():
            letters, end = term.rstrip("*"), "*" if term.endswith("*") else ""
            node = self.root
            for letter in letters:
                node = node.setdefault(letter, {})
            node[end] = weight
            if len(letters) >= MIN_FUZZY:
                self.longest = max(self.longest, len(letters))
                k = _edits(len(letters))
                for rest in _without(letters if k == 1 else letters[:LONG_HEAD], k):
                    self.heads[k - 1].setdefault(rest, []).append((letters, end, weight))

    def exact(self, word: str) -> float | None:
        """The largest weight of the word itself or of a stem it begins with."""
        node, best = self.root, None
        for letter in word:
            node = node.get(letter)
            if node is None:
                return best
            if "*" in node and (best is None or node["*"] > best):
                best = node["*"]
        if "" in node and (best is None or node[""] > best):
            best = node[""]
        return best

    def near(self, word: str) -> set[tuple[str, str, float]]:
        """Terms and stems that share a shortened head with the word: all within reach, and some others."""
        found, (one, two) = [], self.heads
        for n in range(MIN_FUZZY, min(len(word) + 1, 2 * MIN_FUZZY - 1) + 1):
            if len(word) < n:
                found += one.get(word, ())
                break
            for i in range(n):
                found += one.get(word[:i] + word[i + 1:n], ())
        if len(word) >= LONG_HEAD:
            for i in range(LONG_HEAD):
                rest = word[:i] + word[i + 1:LONG_HEAD]
                for j in range(i, LONG_HEAD - 1):
                    found += two.get(rest[:j] + rest[j + 1:], ())
        return set(found)

    def search(self, word: str) -> float | None:
        """The largest weight of a term, or of a stem of a beginning of the word, within one edit, or two for long
        ones; a misspelling counts less."""
        near = self.near(word)
        if not near:
            return None
        at: dict[str, int] = {}
        for i, letter in enumerate(word[:self.longest + 3]):
            at[letter] = at.get(letter, 0) | 1 << i
        whole, best = 1 << len(word), None
        for letters, end, weight in sorted(near, key=lambda t: -t[2]):
            if best is not None and weight <= best:
                break
            k = _edits(len(letters))
            if not end and abs(len(word) - len(letters)) > k:
                continue
            # bit i of a number: i letters of the word are read, with no edit, one and two
            zero, one, two, last, zero_before, one_before = 1, 3, 7 * (k == 2), 0, 0, 0
            for letter in letters:
                own = at.get(letter, 0)
                swap = own & last >> 1
                new = (zero & own) << 1
                new_one = (one & own) << 1 | zero | (zero | new) << 1 | (zero_before & swap) << 2
                if k == 2:
                    two = (two & own) << 1 | one | (one | new_one) << 1 | (one_before & swap) << 2
                zero_before, one_before, zero, one, last = zero, one, new, new_one, own
                if not (two if k == 2 else one):
                    break
            reached = whole if not end else (2 << len(word)) - 1
            for states, share in ((zero, 1.0), (one, 0.8), (two, 0.6)):
                if states & reached:
                    best = weight * share if best is None else max(best, weight * share)
                    break
        return best


def _edits(length: int) -> int:
    return 2 if length >= 2 * MIN_FUZZY else 1


def _without(word: str, k: int) -> set[str]:
    """The word with ``k`` of its letters taken out."""
    out = {word}
    for _ in range(k):
        out = {w[:i] + w[i + 1:] for w in out for i in range(len(w))}
    return out


class _Weights(dict):
    """(weight, misspelled) of words; None for words that match nothing."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self.trie.exact(word)
        out = None if found is None else (found, 0)
        if out is None and (close := self.trie.search(word)) is not None:
            out = (close, 1)
        self[word] = out
        return out


@lru_cache(maxsize=1)
def _weights(terms: tuple[tuple[str, float], ...]) -> _Weights:
    """Kept by a worker from task to task."""
    return _Weights(Trie(dict(terms)))


def features(text: str | None, weights: _Weights) -> np.ndarray:
    """What the hits of a text say, those inside quotations told apart from the others."""
    out = np.zeros(N_FEATURES)
    out[0] = 1.0
    low = (text or "").lower()
    words = WORD.findall(low)
    if not words or not any(weights[w] for w in set(words)):
        return out
    direct, quoted, fuzzy, best, closest, near, kinds = 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, set()
    for match in WORD.finditer(low):
        hit = weights[match[0]]
        if hit is None:
            continue
        weight, misspelled = hit
        before, after = low[max(0, match.start() - CONTEXT):match.start()], low[match.end():match.end() + CONTEXT]
        in_quotes = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
        if in_quotes or SAYING.search(before[-30:]):
            quoted += weight
        elif misspelled:                         # apart, since plain words of other meaning may be as close
            fuzzy += weight
            closest = max(closest, weight)
        else:
            direct += weight
            best = max(best, weight)
        if not misspelled:
            near += weight * bool(ADDRESS.search(before) or ADDRESS.search(after))
            kinds.add(match[0])
    n = len(words)
    out[1:] = (np.log1p(direct), best, np.log1p(len(kinds)), direct / np.sqrt(n), np.log1p(quoted), np.log1p(fuzzy), np.log1p(near),
               fuzzy / np.sqrt(n), closest)
    return out


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document's words and the stems of its words, once each."""
    for batch in batches:
        stems, labels = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            own = set()
            for word in set(WORD.findall((text or "").lower())):
                if len(word) >= MIN_STEM:
                    own.add(word)
                    own.update(word[:k] + "*" for k in range(MIN_STEM + 1, min(len(word), MAX_STEM) + 1))
            stems.extend(own)
            labels.extend([label] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(labels, pa.int64())], ["stem", "label"])


class Detector:
    """Learnt terms with weights, and a logistic model of the features."""

    def __init__(self, terms: dict[str, float], model: np.ndarray):
        self.terms, self.model = terms, model

    @classmethod
    def fit(cls, labelled: DataFrame) -> Detector:
        """``labelled`` has text, label and part (0 or 1): the terms come from part 0, the logistic model from part 1.

        Terms are words and stems (ending in *) that are much more frequent in toxic documents, by log odds.
        """
        sizes = {(r["part"], r["label"]): r["n"] for r in labelled.groupBy("part", "label").agg(F.count("*").alias("n")).collect()}
        toxic, clean = sizes.get((0, 1), 0), sizes.get((0, 0), 0)
        terms = {t: 3.0 for t in SEED_TERMS}
        if toxic and clean:
            counted = (
                labelled.filter("part = 0").select("text", "label").mapInArrow(_stems, "stem string, label bigint")
                .groupBy("stem").agg(F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no")))
            odds = F.log((F.col("yes") + 0.1) / (toxic + 0.2)) - F.log((F.col("no") + 0.5) / (clean + 1.0))
            kept = counted.filter(F.col("yes") >= max(2, round(0.004 * toxic))).withColumn("odds", odds).filter("odds >= 2.2").orderBy((F.col("odds") * F.log1p("yes")).desc(), "stem").limit(MAX_TERMS)
            terms |= {r["stem"]: float(r["odds"]) for r in kept.collect()}
        first = cls(terms, np.zeros(N_FEATURES))
        seen = labelled.filter("part = 1").select("text", "label").mapInArrow(first._featured(), "label bigint, f array<double>").collect()
        x, y = np.array([r["f"] for r in seen]).reshape(-1, N_FEATURES), np.array([r["label"] for r in seen], float)
        share = (sizes.get((0, 1), 0) + sizes.get((1, 1), 0) + 0.5) / (sum(sizes.values()) + 1.0)
        model = np.zeros(N_FEATURES)
        model[0] = np.log(share / (1 - share))
        if 0 < y.sum() < len(y):
            for _ in range(30):                                  # Newton steps with a small ridge
                p = 1 / (1 + np.exp(-np.clip(x @ model, -30, 30)))
                slope = x.T @ (y - p) - 0.05 * model * (np.arange(N_FEATURES) > 0)
                bend = (x * (p * (1 - p))[:, None]).T @ x + np.eye(N_FEATURES) * 0.05
                model = model + np.linalg.solve(bend, slope)
        return cls(terms, model)

    def _featured(self):
        terms = tuple(self.terms.items())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = _weights(terms)
            for batch in batches:
                rows = [features(t, weights).tolist() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], ["label", "f"])

        return run

    def score(self, docs: DataFrame, fields: str) -> DataFrame:
        """Add ``score``, 0 to 1, to rows with a text; ``fields`` names the other columns."""
        terms, model = tuple(self.terms.items()), self.model

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = _weights(terms)
            for batch in batches:
                x = [float(features(t, weights) @ model) for t in batch.column("text").to_pylist()]
                p = 1 / (1 + np.exp(-np.clip(np.array(x, float), -30, 30)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], [*batch.schema.names[:-1], "score"])

        return docs.mapInArrow(run, fields + ", score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", held_out: int = 5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per document: key, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Labels are learnt only from keys whose crc32 is not divisible by ``held_out``, and from about ``max_labelled`` of
    those, drawn by a hash of the key; nothing but the text is scored. Terms match exactly, as stems, or misspelled
    by one edit (two for ten letters and more), and so do stems: all of those with five letters or more. Hits inside quotation marks or after a verb of saying are summed
    apart from direct ones, and misspelt ones apart from both; the logistic model weighs them.

    Null and empty texts have no hits and score like any document without; null labels are left out, a key with
    several labels is toxic if one says so; rows that repeat a key are scored one by one; without labels of both
    kinds the known terms stay and the score is the share of toxic labels. Empty tables are allowed.
    """
    number = lambda c: F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))
    given = labels.select(name(key).alias("__key"), name("toxic").cast("int").alias("label")).filter(
        F.col("label").isNotNull() & F.col("__key").isNotNull() & (number(F.col("__key")) % held_out != 0))
    given = given.groupBy("__key").agg(F.max("label").cast("bigint").alias("label"))
    n = given.count()
    share = min(1.0, max_labelled / max(n, 1))
    drawn = given.filter(F.pmod(F.xxhash64("__key"), F.lit(1_000_000)) < share * 1_000_000)
    drawn = drawn.withColumn("part", F.when(F.pmod(F.xxhash64(F.lit(7), "__key"), F.lit(3)) == 0, 1).otherwise(0))
    side = F.broadcast(drawn) if min(n, 2 * max_labelled) * 32 <= BROADCAST_BYTES else drawn
    labelled = docs.select(name(key).alias("__id"), name("text").cast("string").alias("text")).join(
        side, F.col("__id") == F.col("__key")).select("text", "label", "part").persist()
    detector = Detector.fit(labelled)
    labelled.unpersist()
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(name(key).alias("id"), name("text").cast("string").alias("text"))
    scored = detector.score(rows, f"id {kind}")
    return scored.select(
        F.col("id").alias(key), (number(F.col("id")) % held_out == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
