"""N-gram Jaccard join by vertical partitioning: fragments of one global n-gram order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import BROADCAST_BYTES, Scratch, name
from tabprep.llm.components import components

FRAGMENTS = 8                            # in which overlaps are counted
SIGNATURE = 16                           # longs of bits that can rule a pair out before its tokens move; large sets have more
KEY_BITS = 40                            # of a key: equal keys are candidates only, and fewer bytes move
FIRST = 16                               # least open keys of a node that decide where a pair is met
GAIN = 0.5                               # share of a round's pairs that must link for another round
DOCUMENT_BYTES = 160                     # of a document key as a broadcast holds it, with its slots; it may be a struct of two hashes and an id
PAIR_BYTES = 160                         # of a pair and its hub, held likewise
CACHE_WORDS = 1_000_000                  # per Python worker; a full cache is emptied
SEEN_SETS = 200_000                      # of which a task knows that their keys are listed; emptied likewise
M1, M2, M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * M1
    x = (x ^ (x >> np.uint64(33))) * M2
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    """Word hashes, worked out once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def shingle_set(text: str | None, size: int, cache: _Words) -> np.ndarray:
    """The sorted hashes of the distinct shingles: ``size`` words each, or one of all words if there are fewer."""
    word = (text or "").encode().lower().split()            # bytes: only A-Z, and the six ASCII spaces
    if not word:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, word), np.uint64, len(word))
    n = min(size, len(word))
    out = np.full(len(word) - n + 1, np.uint64(n))
    for i in range(n):
        out = _mix(out * M3 + h[i:len(word) - n + 1 + i])
    return np.unique(out)


def size_classes(percent: int) -> tuple[list[int], list[int]]:
    """Lower bounds of the size classes, and how much two linked sets of a class and the next can differ at most.

    A set that links with one of class k and is not smaller is in class k or k + 1.
    """
    bounds, differ = [1], []
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 100 // percent + 1))
        most = bounds[-1] - 1
        differ.append((most + most * 100 // percent) * (100 - percent) // (100 + percent))
    return bounds, differ


def fragment_keys(tokens: np.ndarray, bounds: list[int], differ: list[int]) -> np.ndarray:
    """Keys of which two sets with the wanted similarity share at least one.

    The global order, that of the hashes, is cut into more fragments than two such sets can differ in places, so
    at least ``slack + 1`` fragments are the same in both. A key is a hash of a fragment with all its content, which
    a passage that unlike documents share does not make alike. Empty fragments count only in sets that have more
    of them than the slack.
    """
    own = int(np.searchsorted(bounds, len(tokens), side="right")) - 1
    out = []
    for k in (own, own - 1):
        if k < 0 or differ[k] == 0:                          # such sets link only if they are equal
            continue
        slack = differ[k] // 50 + 1
        n = differ[k] + 1 + slack
        place = ((tokens >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        sums = np.add.reduceat(_mix(tokens ^ M3), starts)
        tag = np.uint64((k + 1) * int(M2) % (1 << 64))
        label = place[starts] * M1 + tag
        out.append(_mix(sums + label))
        if n - len(starts) > slack:
            empty = np.setdiff1d(np.arange(n, dtype=np.uint64), place[starts])
            out.append(_mix(empty * M1 + tag))
    return np.concatenate(out) >> np.uint64(64 - KEY_BITS) if out else np.empty(0, np.uint64)


def signature(tokens: np.ndarray, longs: int = SIGNATURE) -> np.ndarray:
    """Whether an odd number of tokens has each hash, as bits.

    Tokens of both sets leave no mark on the difference of two signatures: it shows how many tokens are in one only.
    """
    held = np.bincount(((_mix(tokens) >> np.uint64(7)) % np.uint64(64 * longs)).view(np.int64), minlength=64 * longs)
    return np.packbits((held & 1).astype(np.uint8)).view(np.int64)


def long_signature(tokens: np.ndarray, percent: int) -> np.ndarray:
    """A signature in which unlike sets of this size differ by more bits than linked ones can; empty where the short one does."""
    longs = SIGNATURE
    while 32 * longs * (100 + percent) < 2.2 * len(tokens) * (100 - percent):
        longs *= 2
    return signature(tokens, longs) if longs > SIGNATURE else np.empty(0, np.int64)


def _lists(values: list[np.ndarray], kind=np.uint64) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in values])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*values, np.empty(0, kind)]).view(np.int64)))


def _sets(docs: DataFrame, key: str, size: int, percent: int, what: str) -> DataFrame:
    """Per document its set's hash and size, with the keys, or with the tokens by fragment and their signature.

    A task lists the keys of equal sets once; the other documents with that set have an empty list.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = _Words(), set()
        bounds, differ = size_classes(percent)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = [shingle_set(text, size, cache) for text in part.column("text").to_pylist()]
                hashes = [xxhash.xxh3_64_intdigest(tokens.tobytes()) if len(tokens) else 0 for tokens in sets]
                columns = [part.column("key"), pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array([len(x) for x in sets], pa.int64())]
                if what == "keys":
                    lists = []
                    for tokens, h in zip(sets, hashes):
                        fresh = len(tokens) > 0 and h not in seen
                        if len(seen) >= SEEN_SETS:
                            seen.clear()
                        seen.add(h)
                        lists.append(fragment_keys(tokens, bounds, differ) if fresh else np.empty(0, np.uint64))
                    columns.append(_lists(lists))
                else:
                    columns += [_lists(sets), _lists([signature(tokens) for tokens in sets], np.int64),
                                _lists([long_signature(tokens, percent) for tokens in sets], np.int64)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "n", "list", "bits", "more"][:len(columns)])

    fields = f"key {kind}, node bigint, n bigint, list array<bigint>" + (", bits array<bigint>, more array<bigint>" if what == "tokens" else "")
    return docs.select(name(key).alias("key"), name("text").cast("string").alias("text")).mapInArrow(run, fields)


def _allowed(left: str, right: str, both: Column, percent: int) -> Column:
    """Whether two signatures allow the similarity: each bit in which they differ is a token that one of the sets lacks."""
    def near(apart: Column) -> Column:
        return apart * (100 + percent) <= both * (100 - percent)

    def apart(a: Column, b: Column) -> Column:
        bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("bigint"))
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda total, n: total + n)

    def halved(a: Column) -> Column:                     # the signature of half the length
        half = (F.size(a) / 2).cast("int")
        return F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    short = [F.bit_count(F.col(f"{left}{i}").bitwiseXOR(F.col(f"{right}{i}"))) for i in range(SIGNATURE)]
    a, b = F.col(f"{left}more"), F.col(f"{right}more")
    long = F.when((F.size(a) == 0) | (F.size(b) == 0), True).when(F.size(a) == F.size(b), near(apart(a, b)))
    long = long.when(F.size(a) == 2 * F.size(b), near(apart(halved(a), b))).when(F.size(b) == 2 * F.size(a), near(apart(a, halved(b))))
    return near(sum(short[1:], short[0])) & long.otherwise(True)


def _signed(signs: DataFrame, side: str, *kept: str) -> DataFrame:
    return signs.select(F.col("node").alias(f"__{side}"), *[F.col(c).alias(f"{side}{c}") for c in ("n", "more", *kept)], *[
        F.get("bits", F.lit(i)).alias(f"{side}{i}") for i in range(SIGNATURE)])


def _possible(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signatures allow a link."""
    met = pairs.join(_signed(signs, "x"), F.col("u") == F.col("__x")).join(_signed(signs, "y"), F.col("v") == F.col("__y"))
    return met.filter(_allowed("x", "y", F.col("both"), percent)).select("u", "v", "both")


def _overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Intersection sizes: counted fragment by fragment, then summed per pair.

    The tokens of ``v`` travel to those of ``u`` once; the pairs come to both without moving tokens if they are few.
    """
    few = pairs.count() * PAIR_BYTES <= BROADCAST_BYTES
    ends = F.broadcast(pairs.select("u", "v")) if few else pairs.select("u", "v")
    hubs = pairs.select(F.col("u").alias("node")).distinct()
    moved = parts.join(ends, F.col("node") == F.col("v")).select("u", "v", "fragment", F.col("tokens").alias("b"))
    own = parts.join(F.broadcast(hubs) if few else hubs, "node", "left_semi").select(F.col("node").alias("hub"), F.col("fragment").alias("part"), F.col("tokens").alias("a"))
    return (moved.join(own, (F.col("u") == F.col("hub")) & (F.col("fragment") == F.col("part")))
            .select("u", "v", "fragment", F.size(F.array_intersect("a", "b")).alias("partial"))
            .dropDuplicates(["u", "v", "fragment"])                             # of repeated rows
            .groupBy("u", "v").agg(F.sum("partial").alias("common")))


def _linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach the similarity."""
    if pairs.count() * PAIR_BYTES > BROADCAST_BYTES:
        parts = _sieved(parts, "node", pairs.select("u").union(pairs.select("v")))
    counted = _overlaps(pairs, parts).withColumnsRenamed({"u": "__u", "v": "__v"})
    return counted.join(pairs, (F.col("u") == F.col("__u")) & (F.col("v") == F.col("__v"))).filter(
        F.col("common") * 100 >= (F.col("both") - F.col("common")) * percent).select("u", "v")


def _near_sizes(n: str, m: str, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _headed(now: DataFrame) -> DataFrame:
    """The keys of more than one component, with their heads: the nodes with the most shared keys. One shuffle on the key."""
    whole = Window.partitionBy("at")
    return now.withColumns({
        "hub": F.max(F.struct("w", "node", "root", "n")).over(whole), "lo": F.min("root").over(whole), "hi": F.max("root").over(whole)
    }).filter("lo < hi").drop("lo", "hi")


def _hub_pairs(met: DataFrame, percent: int) -> DataFrame:
    """Per node the pair it has the most keys of, of the pairs with the heads of its keys: none with its own component, none tried."""
    met = met.filter((F.col("root") != F.col("hub.root")) & ~F.coalesce(F.array_contains("tried", F.col("hub.node")), F.lit(False)))
    met = met.select(F.col("hub.node").alias("u"), F.col("node").alias("v"), F.col("hub.w").alias("w"), "n", F.col("hub.n").alias("m"))
    met = met.filter(_near_sizes("n", "m", percent)).groupBy("u", "v").agg(
        F.count("*").alias("c"), F.max("w").alias("w"), F.max(F.col("n") + F.col("m")).alias("both"))
    best = met.groupBy("v").agg(F.max(F.struct("c", "w", "u", "both")).alias("best"))
    return best.select("best.u", "v", "best.both")


def _contested(now: DataFrame) -> DataFrame:
    """The keys of more than one component, with that which holds most of each. One shuffle on the key."""
    whole = Window.partitionBy("at")
    open_ = now.select("at", "node", "root", F.min("root").over(whole).alias("lo"), F.max("root").over(whole).alias("hi")).filter("lo < hi")
    held = open_.withColumn("k", F.count("*").over(Window.partitionBy("at", "root")))
    return held.select("at", "node", "root", F.max(F.struct("k", "root")).over(whole)["root"].alias("major"))


def _meetings(now: DataFrame, signs: DataFrame, percent: int, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Where nodes of different components meet whose signatures allow a link.

    A pair that is apart shares open keys only, so its shared keys are counted in full. In a key the nodes of the component that
    holds most of it are met by the others, not by each other. The signatures are compared where the nodes meet, so a
    key with many unlike nodes makes no rows. If the ``FIRST`` least open keys of two nodes have one in common, the pair
    makes a row at the least of those only, not at each of its thousands of shared keys; if both lists are whole, they
    show how many keys are shared, and if not, the pair is taken without a count. ``keep`` may write the open keys,
    which are read three times.
    """
    bounds, differ = size_classes(percent)
    open_ = keep(_contested(now))
    some = open_.filter("root <> major").select(F.col("at").alias("__at"), F.col("node").alias("u"), F.col("root").alias("__root"))
    firsts = open_.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("at")), 1, FIRST).alias("firsts"))
    signed = signs.join(firsts, "node")
    mine = open_.join(_signed(signed, "y", "firsts"), F.col("node") == F.col("__y"))
    yours = some.join(_signed(signed, "x", "firsts"), F.col("u") == F.col("__x"))
    common = F.array_intersect("xfirsts", "yfirsts")
    most = int(bounds[-1])
    least = F.lit(0)
    for low, d in zip(bounds, differ):                       # the class of the smaller set
        if low < most and d:
            least = F.when(F.least("xn", "yn") >= low, F.lit(d // 50 + 2)).otherwise(least)
    whole = (F.size("xfirsts") < FIRST) & (F.size("yfirsts") < FIRST)
    here = F.when(F.arrays_overlap("xfirsts", "yfirsts"), (F.array_min(common) == F.col("at")) & (~whole | (F.size(common) >= least))).otherwise(True)
    return mine.join(yours, (F.col("at") == F.col("__at")) & (F.col("root") != F.col("__root"))
                      & ((F.col("root") == F.col("major")) | (F.col("node") < F.col("u")))
                      & _near_sizes("xn", "yn", percent) & _allowed("x", "y", F.col("xn") + F.col("yn"), percent) & here).select(
        F.greatest("u", "node").alias("u"), F.least("u", "node").alias("v"), (F.col("xn") + F.col("yn")).alias("both"),
        least.alias("least"), F.arrays_overlap("xfirsts", "yfirsts").alias("once"))


def _open_pairs(now: DataFrame, signs: DataFrame, percent: int, tried: DataFrame | None, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All pairs of different components that share enough keys for a link, and whose signatures allow it."""
    counted = _meetings(now, signs, percent, keep).groupBy("u", "v").agg(
        F.count("*").alias("c"), F.max("both").alias("both"), F.max("least").alias("least"), F.max("once").alias("once")).filter("once or c >= least")
    if tried is not None:
        both = tried.union(tried.select("v", "u")).distinct()
        counted = counted.join(both, ["u", "v"], "left_anti")
    return counted.select("u", "v", "both")


def _only(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The documents with a wanted key, the null key included."""
    few = wanted.count() * DOCUMENT_BYTES <= BROADCAST_BYTES
    return docs.join(F.broadcast(wanted) if few else wanted, name(key).eqNullSafe(F.col("__first")), "left_semi")


def _sieved(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key may be among the wanted ones, null included; no wanted one is missed.

    Hashes of the wanted keys are marked in a bit map of a fixed size, which is broadcast: what surely is not wanted
    stays where it is, and only the rest moves in the exact join that follows.
    """
    slots = max(1, BROADCAST_BYTES // 64)                                       # a row of 64 bits takes 64 bytes at most
    marks = wanted.toDF("__key").select(F.pmod(F.xxhash64("__key"), F.lit(64 * slots)).alias("__mark"))
    marks = marks.groupBy(F.expr("__mark div 64").alias("__slot")).agg(F.expr("bit_or(shiftleft(1L, cast(__mark % 64 as int)))").alias("__bits"))
    marked = rows.withColumn("__mark", F.pmod(F.xxhash64(name(column)), F.lit(64 * slots)))
    met = marked.join(F.broadcast(marks), F.expr("__mark div 64") == F.col("__slot"))
    return met.filter(F.expr("getbit(__bits, cast(__mark % 64 as int)) = 1")).drop("__mark", "__slot", "__bits")


def _hooked(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after some links: the lower root of each takes the highest it is linked with, and that one's, if it moves too.

    What it leaves apart is merged later; equal roots always mean connected.
    """
    ends = [roots.select(F.col("node").alias(f"__{e}"), F.col("root").alias(f"r{e}")) for e in "uv"]
    met = links.join(ends[0], F.col("u") == F.col("__u")).join(ends[1], F.col("v") == F.col("__v")).filter("ru <> rv")
    moved = met.groupBy(F.least("ru", "rv").alias("old")).agg(F.max(F.greatest("ru", "rv")).alias("new"))
    again = moved.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    moved = moved.join(again, F.col("new") == F.col("__old"), "left").select("old", F.coalesce("__new", "new").alias("new"))
    return roots.join(moved, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))


def _merged(scratch: Scratch, weight: DataFrame, links: DataFrame | None) -> DataFrame:
    """The component of every node, exact."""
    if links is None:
        return weight.select("node", F.col("node").alias("root"))
    found = weight.select("node").join(components(links), "node", "left")
    return scratch.keep(found.select("node", F.coalesce("root", "node").alias("root")))[0]


def jaccard_classes(docs: DataFrame, key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """Per document: the key, ``n_shingles`` and ``component_id``, the least key that links lead to.

    Two documents link if the shared part of their sets of distinct word shingles is at least ``percent`` of the
    union. Documents with equal sets are one node from the start (sets are told apart by a 64-bit hash). Keys
    (see ``fragment_keys``) that two nodes share make candidates. Not all pairs of a key are tried: in each round
    every node is held against one other, of the heads of its keys (their nodes with the most shared keys) that which it
    shares most keys with, among those it is not connected with. Rounds go on while half of their pairs link; what is still
    apart then is tried pair by pair, if enough keys are shared. Pairs whose signatures leave a link possible are
    counted exactly, in eight fragments whose partial overlaps are summed.

    Documents without words, null texts included, have 0 shingles and stay alone; of several rows with one key
    each gets a row, and they are one document if their texts agree. A null key is allowed and is no least key.
    The table may be empty. Only the key and ``text`` are read. The large intermediate tables are removed once read.
    """
    scratch = Scratch(docs.sparkSession)
    full, full_at = scratch.keep(_sets(docs, key, size, percent, "keys"))
    light, _ = scratch.keep(full.select("key", "node", "n"))
    nodes = light.filter("n > 0").groupBy("node").agg(F.min("key").alias("first"), F.first("n").alias("n"))
    listed = full.select("node", F.explode("list").alias("at"))             # copies once per task: no list moves to find the others
    whole = Window.partitionBy("at")                         # one shuffle on the key at any size, and no table of the shared keys
    held = listed.select("at", "node", F.min("node").over(whole).alias("lo"), F.max("node").over(whole).alias("hi")).filter("lo < hi")
    members, members_at = scratch.keep(held.select("at", "node").distinct())
    scratch.drop(full_at)
    weight = members.groupBy("node").agg(F.count("*").alias("w")).join(nodes, "node")
    weight, _ = scratch.keep(weight.select("node", "w", "n", "first"))
    wanted = weight.select(F.col("first").alias("__first"))
    texts = docs if weight.count() * DOCUMENT_BYTES <= BROADCAST_BYTES else _sieved(docs, key, wanted)
    texts = _only(texts, key, wanted)
    parts, parts_at = scratch.keep(
        _sets(texts, key, size, percent, "tokens")
        .select("node", "n", "bits", "more", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment"), "list")
        .select("node", "n", "fragment", *[F.when(F.col("fragment") == 0, F.col(c)).alias(c) for c in ("bits", "more")],
                F.filter("list", lambda t: F.pmod(F.shiftrightunsigned(t, 61), F.lit(FRAGMENTS)) == F.col("fragment")).alias("tokens")))
    signs = parts.filter("fragment = 0").select("node", "n", "bits", "more").dropDuplicates(["node"])

    sizes, roots, links, tried = weight.select("node", "w", "n"), weight.select("node", F.col("node").alias("root")), None, None
    while True:
        if tried is None:
            held = sizes.withColumns({"root": F.col("node"), "tried": F.lit(None).cast("array<bigint>")})
        else:
            before = tried.groupBy("v").agg(F.collect_set("u").alias("tried"))
            held = sizes.join(roots, "node").join(before, F.col("node") == F.col("v"), "left").drop("v")
        met, met_at = scratch.keep(_headed(members.join(held, "node")))        # keys inside a component stay inside
        scratch.drop(members_at)
        members, members_at = met.select("at", "node"), met_at
        chosen, _ = scratch.keep(_hub_pairs(met, percent))
        pairs, _ = scratch.keep(_possible(chosen, signs, percent))
        new, _ = scratch.keep(_linked(pairs, parts, percent))
        held, found = pairs.count(), new.count()
        if found:
            links = new if links is None else links.union(new)
            roots, _ = scratch.keep(_hooked(roots, new))
        apart, _ = scratch.keep(chosen.join(new, ["u", "v"], "left_anti").select("u", "v"))      # read in every later round
        tried = apart if tried is None else tried.union(apart)
        if found < GAIN * held or not held:
            break
    roots = _merged(scratch, weight, links)
    pairs, _ = scratch.keep(_open_pairs(members.join(roots, "node"), signs, percent, tried, lambda df: scratch.keep(df)[0]))
    new, _ = scratch.keep(_linked(pairs, parts, percent))
    if not new.isEmpty():
        roots = _merged(scratch, weight, new if links is None else links.union(new))
    scratch.drop(members_at, parts_at)
    least = weight.join(roots, "node").groupBy("root").agg(F.min("first").alias("component"))
    placed = roots.join(least, "root").select("node", "component")
    by_node = nodes.join(placed, "node", "left").select(F.col("node").alias("__node"), F.coalesce("component", "first").alias("component"))
    return (light.join(by_node, (F.col("node") == F.col("__node")) & (F.col("n") > 0), "left")
            .select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id")))
