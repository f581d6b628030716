"""Removal of byte strings repeated across documents, by sorting sparse suffixes in range-partitioned buckets."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import body, checkpointed, name

GRAM = 20                                # bytes of an anchor
KEY_BITS = 40                            # of an anchor's hash: enough to tell most anchors apart, contexts are compared exactly
BLOCK_BYTES = (1 << 20, 8 << 20)         # of text in a block: least, most
BLOCKS = 4096                            # wanted of a large table
PART_BYTES = 32 << 20                    # of text in a partition of blocks
RANGE_BYTES = 64 << 20                   # of text whose anchors are counted by one task
MERGE_KEYS = 500_000                     # keys of a range merged at once, about
BUCKET_ROWS = 200_000                    # contexts dealt to one task
SOLVE_ROWS = 64_000                      # distinct contexts solved at once, more if they have equal leading bytes
SAMPLES = 1_000_000                      # anchors whose leading bytes are kept, about, one in 16 at most; those shared are sent to the driver
BROADCAST_ROWS = 500_000                 # groups of equal texts, four numbers each
LAST = (1 << 63) - 1                     # the id of a document without one


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors: in each window of ``length`` bytes the 20-gram of least hash, the last of equals.

    The choice depends on the bytes of the window alone, so equal windows have the same anchor at the same place.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    eight = np.lib.stride_tricks.as_strided(raw, (len(data) - 7, 8), (1, 1))
    eight = np.ascontiguousarray(eight).view(np.uint64).ravel()
    grams = len(data) - GRAM + 1
    h = eight[:grams] * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29)) ^ eight[8:8 + grams]) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32)) ^ eight[12:12 + grams]) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    mask = np.uint64((1 << 31) - 1)
    low = (h & ~mask) | (mask - np.arange(grams, dtype=np.uint64))
    width, have = length - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    place = (mask - (low & mask)).astype(np.int64)
    place = place[np.concatenate(([True], place[1:] != place[:-1]))]
    return place, h[place].view(np.int64)


def keyed(hashes: np.ndarray) -> np.ndarray:
    """Keys of anchors, spread evenly: the hashes themselves are small ones, being the least of a window."""
    return (hashes.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, the lowest bytes of all values first, and other bytes as they are; compressed."""
    raw = b"".join((c.astype("<i8").view(np.uint8).reshape(-1, 8).T if c.dtype != np.uint8 else c).tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(packed[8:], size, asbytes=True), np.uint8) if size else np.empty(0, np.uint8)


def _numbers(raw: np.ndarray, columns: int) -> list[np.ndarray]:
    """The columns of whole numbers at the start of unpacked bytes that hold nothing else."""
    n = len(raw) // (8 * columns)
    return [np.ascontiguousarray(c.T).view("<i8").ravel() for c in raw.reshape(columns, 8, n)]


def _blocks(limit: int):
    """Rows in blocks of about ``limit`` bytes of text, which is compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, held = TaskContext.get().partitionId() << 32, 0, [[], [], [], []]

        def block() -> pa.RecordBatch:
            text = held[3]
            columns = [*held[:3], list(map(len, text))]
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), *[pa.array([c], pa.list_(pa.int64())) for c in columns],
                 pa.array([_packed(np.frombuffer(b"".join(text), np.uint8))], pa.binary())],
                ["block", "ids", "marks", "checks", "sizes", "text"])

        size = 0
        for batch in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "check", "data"))):
                for column, value in zip(held, row):
                    column.append(value)
                size += len(row[3])
                if size >= limit or len(held[0]) >= 1 << 16:
                    yield block()
                    made, held, size = made + 1, [[], [], [], []], 0
        if held[0]:
            yield block()

    return run


class _Block:
    """The texts of a block, the anchors of those that are not copies, and the distinct keys of these."""

    def __init__(self, row: dict, length: int):
        self.length, self.ids = length, np.array(row["ids"], np.int64)
        self.ends = np.cumsum(np.array(row["sizes"], np.int64))
        self.starts = self.ends - np.array(row["sizes"], np.int64)
        self.raw = _unpacked(row["text"])
        self.copies, data = set(row["copies"] or ()), self.raw.tobytes()
        self.docs = [data[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]
        found = [(k, *anchors(x, length)) for k, x in enumerate(self.docs) if k not in self.copies and len(x) >= length]
        self.doc = np.repeat(np.array([k for k, _, _ in found], np.int64), [len(p) for _, p, _ in found])
        self.place = np.concatenate([p for _, p, _ in found] or [np.empty(0, np.int64)])
        self.key = keyed(np.concatenate([h for _, _, h in found] or [np.empty(0, np.int64)]))
        order = np.lexsort((self.doc, self.key))
        key, doc = self.key[order], self.doc[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))[:len(key)]
        self.at = np.flatnonzero(new)                                             # of the distinct keys among the sorted
        self.keys, self.one = key[self.at], order[self.at]                        # and an anchor of each
        once = new | np.concatenate(([True], doc[1:] != doc[:-1]))[:len(key)]
        self.in_docs = np.add.reduceat(once.astype(np.int64), self.at) if len(key) else np.empty(0, np.int64)

    def cuts(self, ranges: int) -> np.ndarray:
        """Where the ranges of keys begin among the distinct ones."""
        return np.searchsorted(self.keys, [-(-(r << KEY_BITS) // ranges) for r in range(ranges + 1)])

    def share(self, bits: list[dict], ranges: int) -> None:
        """Keep the anchors whose keys are shared: the contexts of each, and the distinct ones of these in order."""
        shared, cuts = np.zeros(len(self.keys), bool), self.cuts(ranges)
        for reply in bits or ():
            a, b = cuts[reply["range"]], cuts[reply["range"] + 1]
            shared[a:b] = np.unpackbits(np.frombuffer(reply["bits"], np.uint8), count=b - a)
        hit = np.flatnonzero(shared[np.searchsorted(self.keys, self.key)])
        self.doc, self.place = self.doc[hit], self.place[hit]
        before, m, at = self.length - GRAM, len(hit), self.starts[self.doc] + self.place
        wide = width(self.length)
        rows = np.zeros((m, wide + width(before)), np.uint8)
        n_right, n_left = np.minimum(self.ends[self.doc] - at, self.length), np.minimum(self.place, before)
        for o in range(self.length):
            rows[:, o] = np.where(o < n_right, self.raw[np.minimum(at + o, len(self.raw) - 1)], 0)
        for o in range(before):
            rows[:, wide + o] = np.where(o < n_left, self.raw[np.maximum(at - o - 1, 0)], 0)
        rows[:, wide - 1], rows[:, -1] = n_right, n_left
        order, self.new = grouped(rows)
        self.rows, self.context = rows[order[self.new]], np.empty(m, np.int64)
        self.context[order] = np.cumsum(np.isin(np.arange(m), self.new)) - 1
        ids = self.ids[self.doc][order]
        self.first, self.last = (f.reduceat(ids, self.new) if m else ids for f in (np.minimum, np.maximum))

    def buckets(self, splitters: np.ndarray) -> np.ndarray:
        """Where the buckets begin among the distinct contexts."""
        leading = np.ascontiguousarray(self.rows[:, :GRAM]).view(f"S{GRAM}").ravel()
        return np.concatenate(([0], np.searchsorted(leading, splitters, "left"), [len(leading)]))


def width(n: int) -> int:
    """Bytes of a side of a context: ``n``, one with how many there are, and up to whole eights."""
    return (n // 8 + 1) * 8


def grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of fixed-width byte strings, eight bytes a key and the first deciding, and where other ones begin."""
    keys = rows.view(">u8").astype(np.uint64)
    order, new = np.lexsort(keys.T[::-1]), np.zeros(len(rows), bool)
    new[:1] = True
    for k in range(keys.shape[1]):
        key = keys[order, k]
        new[1:] |= key[1:] != key[:-1]
    return order, np.flatnonzero(new)


def _opened(length: int, make: Callable[[_Block, dict], Iterator[pa.RecordBatch]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                yield from make(_Block(row, length), row)

    return run


def _keys(ranges: int, sampled: int):
    """The distinct keys of a block by range, in how many documents each is, and the leading bytes of sampled ones."""
    def make(block: _Block, row: dict) -> Iterator[pa.RecordBatch]:
        cuts, rows = block.cuts(ranges), []
        for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b = cuts[r], cuts[r + 1]
            picked = a + np.flatnonzero(block.keys[a:b] % sampled == 0)
            at = (block.starts[block.doc] + block.place)[block.one[picked]] if len(picked) else picked
            grams = np.concatenate([block.raw[x:x + GRAM] for x in at.tolist()] or [np.empty(0, np.uint8)])
            rows.append((row["block"], r, _packed(np.diff(block.keys[a:b], prepend=0), block.in_docs[a:b]), grams.tobytes()))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("block", "range", "keys", "grams"), x)) for x in rows],
            pa.schema([("block", pa.int64()), ("range", pa.int32()), ("keys", pa.binary()), ("grams", pa.binary())]))

    return make


def _by_part(column: str, solve: Callable[[int, list[dict]], Iterator[pa.RecordBatch]]):
    """Rows of a partition by their range or bucket, one after the other; they are held compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = defaultdict(list)
        for batch in batches:
            for row in batch.to_pylist():
                parts[row[column]].append(row)
        for part in sorted(parts):
            yield from solve(part, parts.pop(part))

    return run


def _shared(sampled: int):
    """Which keys of each block are in two documents, one bit each, and the leading bytes of the sampled shared keys."""
    def solve(part: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        found = []
        for row in rows:
            keys, in_docs = _numbers(_unpacked(row.pop("keys")), 2)
            found.append((np.cumsum(keys), np.minimum(in_docs, 255).astype(np.uint8), np.zeros(len(keys), bool)))
        low, high = min(int(k[0]) for k, _, _ in found), max(int(k[-1]) for k, _, _ in found) + 1
        pieces, grams = -(-sum(len(k) for k, _, _ in found) // MERGE_KEYS), {}
        bounds = [low + (high - low) * i // pieces for i in range(pieces + 1)]
        cuts = [np.searchsorted(k, bounds) for k, _, _ in found]
        for i in range(pieces):
            keys = np.concatenate([k[c[i]:c[i + 1]] for (k, _, _), c in zip(found, cuts)])
            if not len(keys):
                continue
            in_docs = np.concatenate([n[c[i]:c[i + 1]] for (_, n, _), c in zip(found, cuts)])
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            total = np.add.reduceat(in_docs[order].astype(np.int64), starts)
            shared = np.empty(len(keys), bool)
            shared[order] = np.repeat(total > 1, np.diff(np.append(starts, len(keys))))
            picked = np.flatnonzero((total > 1) & (ordered[starts] % sampled == 0))
            grams.update(zip(ordered[starts[picked]].tolist(), total[picked].tolist()))
            at = 0
            for (_, _, out), c in zip(found, cuts):
                out[c[i]:c[i + 1]] = shared[at:at + c[i + 1] - c[i]]
                at += c[i + 1] - c[i]
        out = []
        for row, (keys, in_docs, shared) in zip(rows, found):
            if shared.any():
                out.append((row["block"], part, np.packbits(shared).tobytes(), int(in_docs[shared].sum(dtype=np.int64)), None))
            for i, k in enumerate(keys[keys % sampled == 0].tolist()):
                if n := grams.pop(k, 0):
                    out.append((None, part, None, n, row["grams"][i * GRAM:(i + 1) * GRAM]))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("block", "range", "bits", "hits", "gram"), x)) for x in out],
            pa.schema([("block", pa.int64()), ("range", pa.int32()), ("bits", pa.binary()), ("hits", pa.int64()), ("gram", pa.binary())]))

    return solve


def _contexts(ranges: int, splitters: np.ndarray):
    """The distinct contexts of a block's shared anchors by bucket, with the first and last document of each."""
    def make(block: _Block, row: dict) -> Iterator[pa.RecordBatch]:
        block.share(row["shared"], ranges)
        cuts, rows = block.buckets(splitters), []
        for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            a, b = cuts[r], cuts[r + 1]
            rows.append((row["block"], r, _packed(block.first[a:b], block.last[a:b] - block.first[a:b], block.rows[a:b].ravel())))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("block", "bucket", "contexts"), x)) for x in rows],
            pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("contexts", pa.binary())]))

    return make


def _least(rows: np.ndarray, first: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For distinct contexts in order: the least document that has each of their windows, as (place, least, mask)."""
    m, widest, wide = len(rows), length - GRAM + 1, width(length)
    right, n_right, left, n_left = rows[:, :length], rows[:, wide - 1], rows[:, wide:], rows[:, -1]
    differs = right[1:] != right[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), length)      # with the suffix before
    grown, least = np.zeros(m, np.uint64), np.full((widest, m), LAST, np.int64)
    for o in range(widest):
        if o:
            grown = (grown + left[:, o - 1].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            grown ^= grown >> np.uint64(32)
        run_id = np.concatenate(([0], np.cumsum(common < length - o))).astype(np.uint64)
        ok = np.flatnonzero((n_right >= length - o) & (n_left >= o))
        if not len(ok):
            continue
        both = (grown[ok] ^ run_id[ok] * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xBF58476D1CE4E5B9)
        at = np.argsort(both, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], both[at][1:] != both[at][:-1])))
        lows = np.minimum.reduceat(first[ok][at], starts)
        out = np.empty(len(ok), np.int64)
        out[at] = np.repeat(lows, np.diff(np.append(starts, len(ok))))
        least[o, ok] = out
    todo, open_ = np.arange(m), least < LAST
    while len(todo := todo[open_[:, todo].any(axis=0)]):
        lowest = np.where(open_[:, todo], least[:, todo], LAST).min(axis=0)
        hit = open_[:, todo] & (least[:, todo] == lowest)
        yield todo, lowest, (hit * (1 << np.arange(widest, dtype=np.int64))[:, None]).sum(axis=0)
        open_[:, todo] &= ~hit


def _solve(length: int):
    """For each block's contexts in a bucket: documents before theirs that have their windows, as (place, least, mask)."""
    wide = width(length) + width(length - GRAM)

    def solve(part: int, found: list[dict]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([int.from_bytes(row["contexts"][:8], "little") // (wide + 16) for row in found])
        ends = np.cumsum(sizes)
        rows, first, last = np.empty((ends[-1], wide), np.uint8), np.empty(ends[-1], np.int64), np.empty(ends[-1], np.int64)
        for row, n, b in zip(found, sizes.tolist(), ends.tolist()):
            raw = _unpacked(row.pop("contexts"))
            first[b - n:b], spread = _numbers(raw[:16 * n], 2)
            last[b - n:b], rows[b - n:b] = first[b - n:b] + spread, raw[16 * n:].reshape(n, wide)
        block, place = np.repeat(np.arange(len(found)), sizes), np.arange(len(rows)) - np.repeat(ends - sizes, sizes)
        order, new = grouped(rows)
        distinct, copies = rows[order[new]], np.diff(np.append(new, len(rows)))
        del rows
        lows, ends = np.minimum.reduceat(first[order], new), np.cumsum(copies)
        leading = distinct[:, :GRAM]
        heads = np.append(np.flatnonzero(np.concatenate(([True], (leading[1:] != leading[:-1]).any(axis=1)))), len(distinct))
        pairs, a = [], 0
        while a < len(distinct):            # equal leading bytes are sorted together
            b = max(int(heads[np.searchsorted(heads, a + SOLVE_ROWS, "right") - 1]), int(heads[np.searchsorted(heads, a, "right")]))
            for at, least, mask in _least(distinct[a:b], lows[a:b], length):
                n = copies[a + at]
                to = order[np.repeat(ends[a + at] - np.cumsum(n), n) + np.arange(n.sum())]       # all rows with this context
                least, mask = np.repeat(least, n), np.repeat(mask, n)
                use = least < last[to]
                pairs.append((to[use], least[use], mask[use]))
            a = b
        to, least, mask = (np.concatenate(c) for c in zip(*pairs)) if pairs else [np.empty(0, np.int64)] * 3
        by = np.lexsort((place[to], block[to]))
        to, least, mask = to[by], least[by], mask[by]
        cuts = np.searchsorted(block[to], np.arange(len(found) + 1))
        yield pa.RecordBatch.from_pylist(
            [{"block": row["block"], "bucket": part, "pairs": _packed(place[to[a:b]], least[a:b], mask[a:b])}
             for row, a, b in zip(found, cuts[:-1], cuts[1:]) if b > a],
            pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("pairs", pa.binary())]))

    return solve


def _runs(block: _Block, pairs: list[dict], splitters: np.ndarray) -> dict[int, list[list[int]]]:
    """The covered bytes of a block's documents as runs: [start, end] in order."""
    if not pairs:
        return {}
    cuts = block.buckets(splitters)
    found = [(cuts[x["bucket"]], *_numbers(_unpacked(x["pairs"]), 3)) for x in sorted(pairs, key=lambda x: x["bucket"])]
    context, least, mask = (np.concatenate(c) for c in zip(*((a + at, low, mask) for a, at, low, mask in found)))
    a, b = (np.searchsorted(context, block.context, side) for side in ("left", "right"))
    hit, n = np.repeat(np.arange(len(block.context)), b - a), b - a
    pair = np.repeat(b - np.cumsum(n), n) + np.arange(n.sum())
    use = least[pair] < block.ids[block.doc[hit]]
    hit, mask = hit[use], mask[pair[use]]
    at = (block.starts[block.doc] + block.place)[hit]
    docs, starts = [], []
    for o in range(block.length - GRAM + 1):
        has = (mask >> o) & 1 == 1
        docs.append(block.doc[hit[has]])
        starts.append(at[has] - o)
    starts, one = np.unique(np.concatenate(starts), return_index=True)
    if not len(starts):
        return {}
    doc = np.concatenate(docs)[one]
    new = np.flatnonzero(np.concatenate(([True], (starts[1:] > starts[:-1] + block.length) | (doc[1:] != doc[:-1]))))
    ends, out = starts[np.append(new[1:], len(starts)) - 1] + block.length, defaultdict(list)
    for k, begin, end in zip(doc[new].tolist(), (starts[new] - block.starts[doc[new]]).tolist(), (ends - block.starts[doc[new]]).tolist()):
        out[k].append([begin, end])
    return out


def _cut(ranges: int, splitters: np.ndarray):
    """Drop the covered runs of a block's documents."""
    def make(block: _Block, row: dict) -> Iterator[pa.RecordBatch]:
        block.share(row["shared"], ranges)
        runs, rows = _runs(block, row["solved"], splitters), []
        for k, data in enumerate(block.docs):
            if k in block.copies:
                spans = [[0, len(data)]] if len(data) >= block.length else []
            else:
                spans = runs.get(k, [])
            ends = [0, *[x for run in spans for x in run], len(data)]
            left = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))
            rows.append((int(block.ids[k]), len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest(), left))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
            ["id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept_bytes"])

    return make


def _splitters(sample: pa.Table, buckets: int) -> np.ndarray:
    """Leading bytes that deal the sampled ones, by their number of rows, into buckets of equal size."""
    if not sample.num_rows or buckets < 2:
        return np.empty(0, f"S{GRAM}")
    sample = sample.sort_by("gram")
    upto = np.cumsum(sample.column("hits").to_numpy())
    at = np.searchsorted(upto, upto[-1] * np.arange(1, buckets) / buckets)
    return np.unique(np.array(sample.column("gram").take(pa.array(at)).to_pylist(), f"S{GRAM}"))


def _partitioned(df: DataFrame, parts: int, column: str) -> DataFrame:
    """Shuffle a table once and write it, so that later joins by the column leave it where it is.

    Spark keeps the partitioning of a checkpoint only if the plan that made it was not adaptive. Whole texts go to
    Python in small batches.
    """
    conf = df.sparkSession.conf
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "256"}
    before = {label: conf.get(label) for label in own}
    try:
        for label, value in own.items():
            conf.set(label, value)
        return checkpointed(df.repartition(parts, column))
    finally:
        for label, value in before.items():
            conf.set(label, value)


def remove_repeats(docs: DataFrame, key: str = "doc_id", length: int = 50) -> DataFrame:
    """Per document: key, ``n_bytes``, ``n_removed``, ``spans`` (start and end of the removed runs), ``kept_sha256``
    and ``kept_bytes``.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller key. Documents equal to
    one with a smaller key go whole; the others, one of each text, are compared. All suffixes
    would be many times the text, so sparse ones are sorted: each window of ``length`` bytes has one anchor,
    chosen by its bytes alone. Anchors whose 20-gram is in one document only are dropped by a count. The rest
    give contexts: the suffix from the anchor and what may stand before it in a window. Equal contexts are one row
    with their first and last document, so copies of any number are summed before they are sorted. Sampled
    splitters deal the contexts by their leading bytes into ranges; equal leading bytes share a range, so no
    window is cut by a boundary. A bucket sorts its suffixes by eight-byte keys; neighbours' common prefixes make
    runs, and runs with equal bytes before the anchor are the same window.

    The texts are shuffled and written once, as compressed blocks in a fixed partitioning. What a block asks (its keys
    by range, its contexts by bucket) and the replies (a bit per key, the least documents of its windows) travel as
    packed numbers, and only the replies move to the block.

    Null texts are empty, documents below the length lose nothing, a null key comes after all others, and rows
    that repeat a key do not remove from each other. An empty table gives an empty table.
    """
    rows = docs.select(
        F.coalesce(name(key).cast("bigint"), F.lit(LAST)).alias("id"), F.xxhash64(body()).alias("mark"),
        F.to_binary(body(), F.lit("utf-8")).alias("data"))
    total = docs.agg(F.sum(F.octet_length(body()))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    limit = min(max(total // BLOCKS, BLOCK_BYTES[0]), BLOCK_BYTES[1])
    parts, ranges = (max(cores, -(-total // size)) for size in (PART_BYTES, RANGE_BYTES))
    sampled = max(16, total // 16 // SAMPLES)
    blocks = _partitioned(
        rows.select("id", "mark", F.crc32("data").alias("check"), "data").sortWithinPartitions("mark", "id").mapInArrow(
            _blocks(limit), "block bigint, ids array<bigint>, marks array<bigint>, checks array<bigint>, sizes array<bigint>, text binary"),
        parts, "block")

    def replied(to: DataFrame, replies: DataFrame, column: str, *fields: str) -> DataFrame:
        """The blocks with what was found for them; ``to`` is partitioned by its block and does not move."""
        by = replies.repartition(parts, "block").groupBy(F.col("block").alias("__block")).agg(F.collect_list(F.struct(*fields) if len(fields) > 1 else fields[0]).alias(column))
        return to.join(by.hint("shuffle_hash"), F.col("block") == F.col("__block"), "left").drop("__block")

    light = blocks.select("block", F.posexplode(F.arrays_zip("ids", "marks", "sizes", "checks")).alias("at", "row")).select("block", "at", "row.*")
    twins = checkpointed(
        light.groupBy("marks", "sizes", "checks").agg(F.min("ids").alias("__first"), F.count("*").alias("n"))
        .filter("n > 1").select(F.col("marks").alias("__m"), F.col("sizes").alias("__s"), F.col("checks").alias("__c"), "__first"))
    equal = (F.col("marks") == F.col("__m")) & (F.col("sizes") == F.col("__s")) & (F.col("checks") == F.col("__c"))
    copies = checkpointed(
        light.join(F.broadcast(twins) if twins.count() <= BROADCAST_ROWS else twins, equal).filter(F.col("__first") < F.col("ids"))
        .select("block", "at"))
    texts = replied(blocks, copies, "copies", "at").select("block", "ids", "sizes", "text", "copies")

    keys = texts.mapInArrow(_opened(length, _keys(ranges, sampled)), "block bigint, range int, keys binary, grams binary")
    shared = checkpointed(keys.repartitionById(ranges, "range").mapInArrow(
        _by_part("range", _shared(sampled)), "block bigint, range int, bits binary, hits bigint, gram binary"))
    hits = shared.agg(F.sum(F.when(F.col("block").isNotNull(), F.col("hits")))).first()[0] or 0
    buckets = max(cores, -(-hits // BUCKET_ROWS))
    splitters = _splitters(shared.filter("gram is not null").select("gram", "hits").toArrow(), buckets)
    texts = replied(texts, shared.filter("block is not null").select("block", "range", "bits"), "shared", "range", "bits")
    contexts = texts.mapInArrow(_opened(length, _contexts(ranges, splitters)), "block bigint, bucket int, contexts binary")
    solved = checkpointed(contexts.repartitionById(buckets, "bucket").mapInArrow(
        _by_part("bucket", _solve(length)), "block bigint, bucket int, pairs binary"))
    out = replied(texts, solved, "solved", "bucket", "pairs").mapInArrow(
        _opened(length, _cut(ranges, splitters)),
        "id bigint, n_bytes bigint, n_removed bigint, spans array<array<bigint>>, kept_sha256 string, kept_bytes binary")
    return out.withColumn("id", F.nullif("id", F.lit(LAST))).withColumnRenamed("id", key)
