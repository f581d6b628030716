"""Text scoring by a class-based log-bilinear model, trained by noise-contrastive estimation on corpus counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import checkpointed, name, written

HEAD = 100_000                           # most frequent words whose counts every task knows; the rest is joined
OWN, GROUPS = 180, 74                    # words with a class of their own, and classes for the others of the head
TAIL, END, START = OWN + GROUPS, OWN + GROUPS + 1, OWN + GROUPS + 2
CLASSES = OWN + GROUPS + 2               # predicted: all but START
SIZE = 24                                # of a class vector
ROUNDS, NOISE, STEP = 4, 64, 0.25
PART_ROWS, LEAST_PARTS = 500_000, 8      # rows of the trigram counts that one part trains on, and parts of small tables
END_HASH = 0
SLICE_BYTES = 2 << 20                     # of text that is taken at a time, whole documents
HELD = 4_000_000                         # trigrams, or words with counts, that a task holds before it passes them on


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of documents of about ``SLICE_BYTES`` of text, one at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if end > start:
            yield batch.slice(start, end - start)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens of some texts, the tokens as places among them, and where each text begins.

    Only A-Z are lowered, and the six ASCII spaces part words. The empty word is the end that each text has.
    """
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ended = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(texts, "", " "))
    split = pc.ascii_split_whitespace(ended)
    found = split.flatten().dictionary_encode()
    _, places, held = found.dictionary.buffers()
    data, places = held.to_pybytes() if held else b"", np.frombuffer(places, np.int32, len(found.dictionary) + 1)
    words = [data[i:j] for i, j in zip(places.tolist(), places[1:].tolist())]              # to_pylist takes four times as long
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)
    hashes = np.where(np.diff(places) == 0, END_HASH, np.where(hashes == 0, 1, hashes))
    ends = split.offsets.to_numpy().astype(np.int64)
    return hashes, found.indices.to_numpy(), ends - ends[0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def flush() -> pa.RecordBatch:
        values, place = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["hash", "n"])

    for batch in batches:
        for part in _slices(batch.filter(batch.column("train"))):
            hashes, tokens, _ = _tokens(part.column("text"))
            held.append((hashes, np.bincount(tokens, minlength=len(hashes))))
            n += len(hashes)
            if n > HELD // 4:
                yield flush()
                held, n = [], 0
    if held:
        yield flush()


class Head:
    """The frequent words: sorted hashes, counts and classes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.lexsort((hashes, -counts))
        kind = np.arange(len(hashes), dtype=np.int64)
        rest = np.cumsum(counts[order][OWN:])
        kind[OWN:] = OWN + np.minimum(GROUPS - 1, (rest - 1) * GROUPS // (rest[-1] if len(rest) else 1))
        classes = np.empty(len(hashes), np.int64)
        classes[order] = kind
        by_hash = np.argsort(hashes)
        self.hashes, self.counts, self.classes = hashes[by_hash], counts[by_hash], classes[by_hash]
        self.class_counts = np.bincount(self.classes, self.counts, CLASSES)

    def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the head, and whether there is one."""
        if not len(self.hashes):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
        place = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
        return place, self.hashes[place] == tokens

    def classify(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, found = self.find(tokens)
        kinds = np.where(found, self.classes[place] if len(self.classes) else 0, TAIL)
        return np.where(tokens == END_HASH, END, kinds), place, found


def _contexts(kinds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The two classes before each token as one code; texts begin with two start marks."""
    one = np.concatenate(([START], kinds[:-1]))
    two = np.concatenate(([START, START], kinds[:-2]))[:len(kinds)]
    one[starts] = START
    two[starts] = START
    later = starts + 1
    two[later[later < len(kinds)]] = START
    return two * (CLASSES + 1) + one


def _trigrams(head: Head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts)], ["code", "n"])

        for batch in batches:
            for part in _slices(batch.filter(batch.column("train"))):
                hashes, tokens, ends = _tokens(part.column("text"))
                kinds = head.classify(hashes)[0][tokens]
                held.append((_contexts(kinds, ends[:-1]) * CLASSES + kinds).astype(np.int32))       # below 2 ** 25
                n += len(kinds)
                if n > HELD:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return run


class LogBilinear:
    """Vectors of context and predicted classes, a matrix for each of the two places before, and biases."""

    def __init__(self, values: list[np.ndarray]):
        self.context, self.target, self.near, self.far, self.bias = values

    @classmethod
    def fresh(cls, unigram: np.ndarray, seed: int = 3) -> LogBilinear:
        rng = np.random.default_rng(seed)
        return cls([
            rng.normal(0, 0.1, (CLASSES + 1, SIZE)), rng.normal(0, 0.1, (CLASSES, SIZE)), np.eye(SIZE), np.eye(SIZE) * 0.5,
            np.log(unigram)])

    def values(self) -> list[np.ndarray]:
        return [self.context, self.target, self.near, self.far, self.bias]

    def train(self, code: np.ndarray, n: np.ndarray, noise: np.ndarray, seed: int, step: float, batch: int = 4096) -> None:
        """One pass of noise-contrastive estimation over every row of some trigram counts, noise from the class unigram.

        A row is met with its count as weight; rows above the mean count are met several times, with equal shares.
        """
        rng = np.random.default_rng(seed)
        log_noise, table = np.log(NOISE * noise).astype(np.float32), np.cumsum(noise)
        spread = lambda at, values: np.bincount(
            (at[:, None] * SIZE + np.arange(SIZE)).ravel(), values.ravel(), CLASSES * SIZE + SIZE).reshape(-1, SIZE)
        times = np.ceil(n / n.mean()).astype(np.int64)
        met = rng.permutation(np.repeat(np.arange(len(n)), times))
        weight = n / times
        usual = weight[met].mean()
        squares = [np.full_like(v, 1e-3) for v in self.values()]
        for at in range(0, len(met), batch):
            rows = met[at:at + batch]
            c, share = code[rows], (weight[rows] / (usual * len(rows))).astype(np.float32)
            word, one, two = c % CLASSES, c // CLASSES % (CLASSES + 1), c // CLASSES // (CLASSES + 1)
            r1, r2 = self.context[one], self.context[two]
            q = r1 @ self.near + r2 @ self.far
            drawn = np.searchsorted(table, rng.random(NOISE)).clip(0, CLASSES - 1)        # shared by the batch
            own, other = self.target[word], self.target[drawn]
            right = (own * q).sum(axis=1) + self.bias[word] - log_noise[word]
            wrong = q @ other.T + self.bias[drawn] - log_noise[drawn]
            up = share / (1.0 + np.exp(np.clip(right, -30, 30)))
            down = -share[:, None] / (1.0 + np.exp(-np.clip(wrong, -30, 30)))
            dq = up[:, None] * own + down @ other
            grads = [
                spread(one, dq @ self.near.T) + spread(two, dq @ self.far.T),
                (spread(word, up[:, None] * q) + spread(drawn, down.T @ q))[:CLASSES], r1.T @ dq, r2.T @ dq,
                np.bincount(word, up, CLASSES) + np.bincount(drawn, down.sum(axis=0), CLASSES)]
            for value, grad, square in zip(self.values(), grads, squares):
                square += (grad * grad).astype(np.float32)
                value += (step * grad / np.sqrt(square) * 0.1).astype(np.float32)

    def log_totals(self) -> np.ndarray:
        """The logarithm that normalises each context, by products of batches of contexts with all classes."""
        near, far = self.context @ self.near, self.context @ self.far
        out = np.empty((CLASSES + 1) ** 2)
        for two in range(CLASSES + 1):
            score = (near + far[two]) @ self.target.T + self.bias
            top = score.max(axis=1)
            out[two * (CLASSES + 1):(two + 1) * (CLASSES + 1)] = top + np.log(np.exp(score - top[:, None]).sum(axis=1))
        return out


class Scorer:
    """Log10 probabilities of classes in their contexts, from the parameters and one total per context."""

    def __init__(self, model: LogBilinear):
        self.near, self.far = [(model.context @ m).astype(np.float32) for m in (model.near, model.far)]
        self.target, self.bias, self.totals = model.target.astype(np.float32), model.bias, model.log_totals()

    def __call__(self, contexts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        two, one = np.divmod(contexts, CLASSES + 1)
        score = np.einsum("ij,ij->i", self.near[one] + self.far[two], self.target[kinds])
        return (score + self.bias[kinds] - self.totals[contexts]) / np.log(10)


def _fit(trigrams: DataFrame, unigram: np.ndarray) -> LogBilinear:
    """Rounds of local training on the parts of the counts; their mean is the next round's start."""
    noise = unigram ** 0.75
    noise /= noise.sum()
    model = LogBilinear.fresh(unigram)
    shapes = [v.shape for v in model.values()]
    for turn in range(ROUNDS):
        now = [v.copy() for v in model.values()]

        def run(batches: Iterator[pa.RecordBatch], now=now, turn=turn) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held) if (held := list(batches)) else None
            if table is None or not table.num_rows:
                return
            local = LogBilinear([v.astype(np.float32) for v in now])
            n = table.column("n").to_numpy().astype(np.float64)
            local.train(table.column("code").to_numpy(), n, noise, turn, STEP / (1 + 0.5 * turn) * 4)
            flat = np.concatenate([v.ravel() for v in local.values()])
            yield pa.RecordBatch.from_arrays([pa.array([float(n.sum())]), pa.array([flat.tolist()])], ["weight", "flat"])

        got = trigrams.mapInArrow(run, "weight double, flat array<double>").collect()         # one row per part
        if not got:
            break
        flat = np.average([r["flat"] for r in got], axis=0, weights=[r["weight"] for r in got])
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        model = LogBilinear([v.reshape(s) for v, s in zip(np.split(flat, cuts), shapes)])
    return model


def _score(head: Head, scorer: Scorer, scale: float, total: int):
    """Sums over the tokens whose counts are known here, and the other tokens by hash."""
    inside = np.log10(np.maximum(head.counts, 1) / np.maximum(head.class_counts[head.classes], 1)) if len(head.counts) else np.empty(0)
    base = np.log10((head.counts + 0.1) / scale)
    end_base = np.log10((total + 0.1) / scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                hashes, tokens, ends = _tokens(part.column("text"))
                kinds, place, found = [v[tokens] for v in head.classify(hashes)]
                is_end = kinds == END
                model = scorer(_contexts(kinds, ends[:-1]), kinds)
                if len(inside):
                    model += np.where(found, inside[place], 0.0)
                own = np.where(is_end, end_base, np.where(found, base[place] if len(base) else 0.0, 0.0))
                known = found | (is_end & (total > 0))
                open_ = ~(found | is_end)
                doc = np.repeat(np.arange(part.num_rows), np.diff(ends))
                starts = ends[:-1]
                rest = hashes[tokens[open_]]
                order = np.lexsort((rest, doc[open_]))
                rest, owner = rest[order], doc[open_][order]
                new = np.flatnonzero(np.concatenate(([True], (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1])))) if len(rest) else np.empty(0, np.int64)
                times = np.diff(np.append(new, len(rest)))
                cuts = np.searchsorted(owner[new], np.arange(part.num_rows + 1)) if len(new) else np.zeros(part.num_rows + 1, np.int64)
                lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(v.astype(np.int64))) for v in (rest[new], times)]
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("id"), part.column("train"), pa.array(np.diff(ends)),
                    pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(own, starts)),
                    pa.array(np.add.reduceat(model, starts)), *lists,
                ], ["row", "id", "train", "n_tokens", "n_known", "base_score", "score", "hashes", "times"])

    return run


def score_texts(docs: DataFrame, key: str = "doc_id", held_out: int = 10) -> DataFrame:
    """Per document: key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    All figures come from all training documents, those whose crc32 of the key is not divisible by ``held_out``.
    Words are counted; the most frequent ``HEAD`` that occur at least twice are known to every task, the others are
    joined by hash. A token has a class: its own for the most frequent words, one of 74 for the rest of the head,
    one for all other words, one for the end. The model predicts a class from the two before it: context vectors
    times a matrix per place, against target vectors. It is trained on every row of the counts of class trigrams, weighted by
    its count, by noise-contrastive estimation in parts, whose number grows with the rows and whose parameters are averaged. A word's probability is that of its
    class times its share of the class; words never seen share the mass that Good and Turing give them. Class
    probabilities are normalised over all classes, by matrix products over batches of contexts.

    Null texts are empty: only their end is scored. Rows that repeat a key are scored one by one, a null key counts
    as held out, and without training documents every token is unknown. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    number = F.crc32(F.coalesce(name(key).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(name(key).alias("id"), (number % held_out != 0).alias("train"), name("text").cast("string").alias("text"))
    id_type = docs.schema[key].dataType.simpleString()
    counts = checkpointed(rows.mapInArrow(_count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")))
    total, distinct, once, ends = counts.agg(
        F.sum("n"), F.count("*"), F.sum((F.col("n") == 1).cast("int")), F.sum(F.when(F.col("hash") == END_HASH, F.col("n")))).first()
    total, ends = total or 0, ends or 0
    top = counts.filter(f"n > 1 and hash <> {END_HASH}").orderBy(F.col("n").desc(), "hash").limit(HEAD).toArrow()
    head = Head(top.column("hash").to_numpy(), top.column("n").to_numpy())
    in_head = int(head.counts.sum())
    tail = total - ends - in_head
    unseen = (once or 0) / ((once or 0) + tail) if tail else 1.0
    unigram = head.class_counts.astype(np.float64)
    unigram[TAIL], unigram[END] = tail, ends
    unigram = (unigram + 0.5) / (unigram.sum() + 0.5 * CLASSES)
    trigrams = written(rows.mapInArrow(_trigrams(head), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")))
    parts = max(LEAST_PARTS, -(-trigrams.count() // PART_ROWS))
    model = _fit(checkpointed(trigrams.repartition(parts, F.xxhash64("code")).sortWithinPartitions("code")), unigram)
    scale = total + 0.1 * (distinct + 1)

    fields = (f"row bigint, id {id_type}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
              "hashes array<bigint>, times array<bigint>")
    marked = rows.select("id", "train", "text", F.xxhash64("id", F.coalesce("text", F.lit(""))).alias("row"))
    scored = checkpointed(marked.select("row", "id", "train", "text").mapInArrow(_score(head, Scorer(model), scale, ends), fields))
    rest = scored.select("row", F.inline(F.arrays_zip("hashes", "times"))).withColumnsRenamed({"hashes": "hash", "times": "n"}).distinct()
    known = counts.select(F.col("hash").alias("__hash"), F.col("n").alias("__count"))
    joined = rest.join(known, F.col("hash") == F.col("__hash"), "left").select("row", "n", F.coalesce("__count", F.lit(0)).alias("c"))
    word = F.when(F.col("c") > 0, F.log10((1 - F.lit(unseen)) * F.col("c") / F.lit(float(max(tail, 1))))).otherwise(F.log10(F.lit(unseen or 1e-9)))
    added = joined.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))).alias("__known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.1) / F.lit(float(scale)))).alias("__base"),
        F.sum(F.col("n") * word).alias("__score")).withColumnRenamed("row", "__row")
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return (scored.drop("hashes", "times").join(added, F.col("row") == F.col("__row"), "left")
            .select(F.col("id").alias(key), (~F.col("train")).alias("held_out"), "n_tokens", plus("n_known", "__known").alias("n_known"),
                    F.lit(total).cast("bigint").alias("train_tokens"), plus("base_score", "__base").alias("base_score"),
                    plus("score", "__score").alias("score")))
