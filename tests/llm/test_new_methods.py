"""Whitening, spelling variants and language of texts against brute force, and on odd rows."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.llm import language_id, queries, spelling
from tabprep.llm import jaccard
from tabprep.llm.jaccard import jaccard_classes
from tabprep.llm.language_id import Features, Leader, identify
from tabprep.llm.spelling import neighbourhood, variant_groups
from tabprep.llm.whiten import refined_eigen, whiten

DATA = "/root/testdata/sf0.001"


def run(spark, n):
    label = next(k for k in queries.QUERIES if k.startswith(f"op{n}_"))
    return queries.QUERIES[label](spark, DATA).toPandas()


# ---- whitening

@pytest.mark.parametrize("values", [
    np.r_[np.ones(8), 1 + 1e-9 * np.arange(8), 1e-8 * np.arange(1, 15)], np.r_[[1e6] * 5, np.ones(25)],
    np.r_[np.ones(20), np.zeros(10)], 10.0 ** -np.arange(30), np.arange(1.0, 31.0)])
def test_refinement_separates_clusters_and_stays_orthogonal(values):
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(30, 30)))[0].astype(np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = refined_eigen(a)
    assert np.abs(x.T @ x - np.eye(30)).max() < 4e-15
    assert np.abs(a @ x - x * found).max() < 1e-16 * np.abs(a).max()
    assert np.abs(found - np.sort(values)[::-1]).max() < 2e-15 * values.max()


def test_whitening_query_against_numpy(spark):
    got = run(spark, 11)
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    x = np.floor(np.stack(rows.embedding).astype(float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = x - s / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert got.component.dtype == np.int32 and len(got) == 32 * n and (got.n == n).all()
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows.vec_id].to_numpy()
    assert np.abs(np.abs(table) - np.abs(z @ vectors[:, :32] / np.sqrt(values[:32]))).max() < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), values[:32] / values.sum(), rtol=1e-10)
    deviation = dict(zip(rows.vec_id, ((n * x - s) ** 2).sum(axis=1)))
    assert (got.deviation == got.vec_id.map(deviation)).all()


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (None, [1.0, 0.5], 2), (3, [-1.0, 0.25], 3), (4, None, 4), (5, [1.0, None], 5),
           (6, [nan, 1.0], 6), (7, [inf, 1.0], 7), (8, [], 8), (9, [1.0, 2.0, 3.0], 9), (10, [1e30, 0.0], 10)]
    df = spark.createDataFrame(odd, "vec_id bigint, embedding array<double>, n int")
    got = whiten(df).orderBy("vec_id").collect()
    assert [r.vec_id for r in got] == [None, 1, 1, 3] and {r.n for r in got} == {4}
    assert all(len(r.whitened) == len(r.explained) == 2 for r in got) and got[1].whitened == got[2].whitened
    assert sum(got[0].explained) == pytest.approx(1.0) and got[0].identity_error < 1e-12
    constant = whiten(df.filter("vec_id = 1")).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in constant] == [(0, [], [], 0.0)] * 2
    assert whiten(df.filter("vec_id > 99")).collect() == []
    far = spark.createDataFrame([(1, [1e9]), (2, [-1e9])], "vec_id bigint, embedding array<double>")
    assert [r.deviation for r in whiten(far).collect()] == [None, None]            # beyond a long


# ---- n-gram Jaccard join

def brute_components(texts, size, percent):
    sets = [frozenset(tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))) if (w := t.split()) else frozenset() for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for j, b in enumerate(sets):
        for i in range(j):
            a = sets[i]
            if a and b and 100 * (both := len(a & b)) >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("size,percent", [(5, 80), (4, 85)])
def test_many_near_copies_of_few_texts(spark, size, percent):
    """A group of hundreds of near copies, about the limit of similarity, and a passage that many other texts share."""
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 50_000, n)]
    base, passage, texts = word(120), word(30), []
    for i in range(360):
        copy = list(base)
        for _ in range(int(rng.integers(0, 6))):
            copy[int(rng.integers(0, 120))] = word(1)[0]
        texts.append(copy if i % 3 else word(int(rng.integers(5, 60))) + passage + word(int(rng.integers(0, 20))))
    texts = [" ".join(t) for t in texts]
    want = brute_components(texts, size, percent)
    got = jaccard_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), size=size, percent=percent)
    assert [r.component_id for r in got.orderBy("doc_id").collect()] == want
    assert 5 < len(set(want)) < 340


# ---- spelling variants

def damaged(rows):
    """Word counts by the letter of the definition."""
    out = collections.Counter()
    for key, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(words):
    out, best = {}, {}
    for w, n in words.items():
        near = [(-m, v) for v, m in words.items() if abs(len(v) - len(w)) <= 1 and v != w and one_edit(v, w)]
        top = min(near, default=None)
        best[w] = top[1] if top and -top[0] >= 10 * n else None
        out[w] = (n, len(near), best[w], -top[0] if best[w] else None)
    for w in out:
        root = w
        while best[root]:
            root = best[root]
        out[w] += (root,)
    return out


def as_map(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_neighbourhoods_hold_every_edit():
    rng = np.random.default_rng(1)
    size, words = 3, rng.integers(1, 4, (20, 6))
    value = lambda w: sum(int(s) * pow(spelling.BASE, i, 1 << 64) for i, s in enumerate(w)) % (1 << 64)
    own, near = neighbourhood(words, size)
    for w, o, hashes in zip(words.tolist(), own.tolist(), near.tolist()):
        edits = [w[:i] + w[i + 1:] for i in range(6)] + [w[:i] + [c] + w[i + 1:] for i in range(6) for c in range(1, 4)]
        edits += [w[:i] + [c] + w[i:] for i in range(7) for c in range(1, 4)]
        assert o == value(w) and set(hashes) == {value(e) for e in edits}


def test_variants_against_brute_force(spark):
    rng = np.random.default_rng(2)
    stems = ["".join(rng.choice(list("abcdeé"), 9)) for _ in range(25)]
    texts = []
    for key in range(120):
        words = []
        for _ in range(60):
            w = stems[min(int(rng.exponential(4)), 24)]
            for _ in range(int(rng.integers(0, 3)) if rng.random() < 0.4 else 0):
                at = int(rng.integers(0, len(w)))
                w = [w[:at] + w[at + 1:], w[:at] + "z" + w[at:], w[:at] + "é" + w[at + 1:]][int(rng.integers(0, 3))]
            words.append(w.upper() if rng.random() < 0.1 else w)
        texts.append((key, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    want = brute_variants(damaged(texts))
    assert as_map(variant_groups(docs)) == want
    assert any(v[2] for v in want.values()) and any(v[4] not in (w, v[2]) for w, v in want.items() if v[2])


def test_variants_on_odd_rows(spark):
    long = "abcdefghij" * 3000
    odd = [(1, None, 1), (2, "", 2), (3, "Überraschung überraschung ÜBERRASCHUNG ×÷ Ω日本 x", 3), (3, "Überraschung überraschung", 3),
           (None, "seventy seventy seventh 7seventh7", 4), (5, long + " " + long + "x " + long, 5), (6, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa", 6)]
    df = spark.createDataFrame(odd, "doc_id bigint, text string, word int")
    assert as_map(variant_groups(df)) == brute_variants(damaged([(r[0], r[1]) for r in odd]))
    assert variant_groups(df.filter("doc_id = 99")).collect() == []


def test_chains_of_forms_end_at_their_root(spark):
    words = {"abcdefg": 2, "abcdefgh": 40, "abcdefghi": 500, "abcdefghij": 5000, "abcdefgz": 3}
    text = " ".join(" ".join([w] * n) for w, n in words.items())
    key = next(k for k in range(1000) if damaged([(k, text)]) == words)
    got = as_map(variant_groups(spark.createDataFrame([(key, text)], "doc_id bigint, text string")))
    assert got["abcdefg"] == (2, 2, "abcdefgh", 40, "abcdefghij") and got["abcdefghij"][2:] == (None, None, "abcdefghij")


# ---- language

LANGUAGES = {"aa": "ban den fir gol hum", "bb": "zyx wuq vyk qux jyz", "cc": "été çaro ñandu über øst"}


def speech(rng, lang, n):
    return " ".join(rng.choice(LANGUAGES[lang].split(), n))


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = "Ab, cd  ef! 12 gh--İx  日本語 " * 40
    features = Features()
    whole = features.counts(text)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language_id, "BLOCK", size)
        assert (features.counts(text) == whole).all()
    assert features.counts("12 .. \n") is None and features.counts(None) is None


def test_leader_gives_sparse_weights_that_separate():
    rng, state = np.random.default_rng(0), Leader.fresh(2)
    for _ in range(300):
        label = int(rng.integers(0, 2))
        state.learn(np.array([label, 10 + int(rng.integers(0, 2000))]), np.array([0.9, 0.05]), label)
    w = state.weights()
    assert w[0, 0] > 0 > w[1, 0] and w[1, 1] > 0 > w[0, 1]
    assert np.mean(w[10:2010] == 0) > 0.9                                  # what carries nothing is exactly zero


def test_languages_of_held_out_documents(spark):
    got = run(spark, 13).set_index("doc_id")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").toPandas().set_index("doc_id")
    held = np.array([zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index])
    assert (got.held_out == held).all() and len(got) == len(docs) and got.score.between(0, 1).all()
    right = got.lang_pred == docs.lang.loc[got.index]
    assert right[held].mean() > 0.95
    assert abs(got.score[held].mean() - right[held].mean()) < 0.1          # calibrated


def test_language_is_learnt_from_marked_rows_alone(spark):
    """Labels of held-out rows, however wrong, change nothing."""
    rng = np.random.default_rng(5)
    rows = [(i, speech(rng, lang, 12), lang) for i, lang in enumerate(list(LANGUAGES) * 40)]
    lied = [(i, t, lang if zlib.crc32(str(i).encode()) % 4 != 2 else "aa") for i, t, lang in rows]
    fields = "doc_id bigint, text string, lang string"
    one, two = [sorted(map(tuple, identify(spark.createDataFrame(r, fields)).collect())) for r in (rows, lied)]
    assert one == two and all(pred == rows[i][2] for i, _, pred, _ in one)


def test_languages_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, speech(rng, lang, 12), lang, 0) for i, lang in enumerate(list(LANGUAGES) * 20)]
    odd = [(1000, None, "aa", 0), (1001, "", None, 0), (1002, "12 + 3 = !?", "bb", 0), (None, speech(rng, "bb", 9), None, 0), (1003, speech(rng, "cc", 200_000), None, 0),
           (1004, "ban den", None, 0), (1004, "ban den", None, 0)]
    df = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score int")
    got = collections.defaultdict(list)
    for r in identify(df).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    assert got[1000] == got[1001] == got[1002] == [("und", 0.0)]
    assert got[None][0][0] == "bb" and got[1003][0][0] == "cc" and len(got[1004]) == 2 and got[1004][0] == got[1004][1]
    assert identify(df.filter("doc_id = -1")).collect() == []
    unlabelled = identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    one = identify(df.withColumn("lang", F.lit("xx"))).filter("doc_id = 0").first()
    assert one.lang_pred == "xx" and math.isclose(one.score, 1.0)


def test_a_pair_meets_at_one_of_its_keys(spark):
    """Two nodes with 1,000 shared keys made 1,000 rows; without a common key among their least they still make one each."""
    keys = [(at, node, node) for node in (1, 2) for at in range(1000)]
    keys += [(at, 3, 3) for at in range(2000, 2040)] + [(at, 4, 4) for at in range(1980, 2004)] + [(at, 5, 5) for at in range(1980, 2000)]
    now = spark.createDataFrame(keys, "at bigint, node bigint, root bigint")
    signs = spark.createDataFrame([(node, 1000, [0] * jaccard.SIGNATURE, []) for node in range(1, 6)], "node bigint, n bigint, bits array<bigint>, more array<bigint>")
    rows = sorted(tuple(r) for r in jaccard._meetings(now, signs, 80).groupBy("u", "v").count().collect())
    assert rows == [(2, 1, 1), (4, 3, 4), (5, 4, 1)]


def test_broadcasts_are_bounded_by_what_they_hold(spark):
    """A million keys take tens of MB on the driver, so they are shuffled; a few are broadcast."""
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    for n, few in ((1_000, True), (1_000_000, False)):
        plan = jaccard._only(docs, "doc_id", spark.range(n).select(F.col("id").alias("__first")))
        assert ("ResolvedHint (strategy=broadcast)" in plan._jdf.queryExecution().analyzed().toString()) == few
        pairs = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + n).alias("v"))
        parts = spark.range(10).selectExpr("id as node", "0 as fragment", "array(id) as tokens")
        plan = jaccard._overlaps(pairs, parts)
        assert ("ResolvedHint (strategy=broadcast)" in plan._jdf.queryExecution().analyzed().toString()) == few


def test_classes_with_and_without_broadcasts(spark, monkeypatch):
    texts = [" ".join(f"w{n}x{i}" for i in range(80)) + tail for n in range(6) for tail in ("", " more", " and again")] + [None, ""]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (4, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    least = {text: i - i % 3 for i, text in enumerate(texts) if text}
    want = sorted(str((i, least.get(text, i))) for i, text in rows)
    for most in (jaccard.BROADCAST_BYTES, 0):
        monkeypatch.setattr(jaccard, "BROADCAST_BYTES", most)
        assert sorted(str((r.doc_id, r.component_id)) for r in jaccard_classes(docs).collect()) == want


def test_key_lists_of_copies_are_left_out_where_they_arise(spark):
    """Each had one, and from 209,715 sets on all lists were shuffled to find the others."""
    texts = [" ".join(f"w{n}x{i}" for i in range(60)) for n in range(3)]
    docs = spark.createDataFrame([(i, texts[i % 3]) for i in range(12)] + [(12, None), (13, "")], "doc_id bigint, text string").coalesce(1)
    rows = jaccard._sets(docs, "doc_id", 4, 85, "keys").collect()
    assert len(rows) == 14 and sorted(len(r.list) > 0 for r in rows) == [False] * 11 + [True] * 3
    apart = jaccard._sets(docs.repartition(4), "doc_id", 4, 85, "keys").collect()
    assert {r.node for r in apart if r.list} == {r.node for r in rows if r.n}           # a full task list hides no set


def test_only_texts_are_filtered_by_document(spark, monkeypatch):
    """The lists of keys were, too; the classes are those of brute force, with full memories of sets."""
    seen, only = [], jaccard._only
    monkeypatch.setattr(jaccard, "_only", lambda docs, *rest: (seen.append(docs.columns), only(docs, *rest))[1])
    monkeypatch.setattr(jaccard, "SEEN_SETS", 1)
    monkeypatch.setattr(jaccard, "BROADCAST_BYTES", 64 * 64)
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(base[:80 - i % 7]) for i in range(21)] + [" ".join(f"v{n}x{i}" for i in range(40 + n % 2)) for n in (1, 2, 3)]
    got = jaccard_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), size=4, percent=85)
    assert [r.component_id for r in got.orderBy("doc_id").collect()] == brute_components(texts, 4, 85)
    assert seen == [["doc_id", "text"]]


def test_open_keys_and_heads_against_a_count(spark):
    rng = np.random.default_rng(3)
    rows = {(int(at), int(node)) for at, node in zip(rng.integers(0, 60, 200), rng.integers(0, 30, 200))}
    root = [int(x) for x in rng.integers(0, 4, 30)]
    now = spark.createDataFrame([(at, node, root[node], node % 5, 100 + node) for at, node in rows], "at bigint, node bigint, root bigint, w bigint, n bigint")
    held, by = collections.defaultdict(collections.Counter), collections.defaultdict(list)
    for at, node in rows:
        held[at][root[node]] += 1
        by[at].append((node % 5, node, root[node], 100 + node))
    want = sorted((at, node, root[node], max(held[at], key=lambda r: (held[at][r], r))) for at, node in rows if len(held[at]) > 1)
    assert sorted(tuple(r) for r in jaccard._contested(now).collect()) == want
    headed = jaccard._headed(now)
    assert sorted((r.at, r.node, tuple(r.hub)) for r in headed.collect()) == sorted((at, node, max(by[at])) for at, node, *_ in want)
    for plan in (headed, jaccard._contested(now)):
        assert plan._jdf.queryExecution().sparkPlan().toString().count("Join") == 0


def test_a_sieve_misses_no_wanted_row(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_BYTES", 64 * 1024)                          # 65,536 bits
    kind = "struct<missing: boolean, id: bigint>"
    docs = spark.range(20_000).select(F.when(F.col("id") > 0, F.struct(F.lit(False).alias("missing"), "id")).cast(kind).alias("a.key"))
    wanted = docs.limit(1).union(docs.filter("`a.key`.id % 40 = 0"))
    ids = {r[0] if r[0] is None else r[0].id for r in jaccard._sieved(docs, "a.key", wanted).collect()}
    assert {None} | set(range(40, 20_000, 40)) <= ids | {None} and len(ids) < 1500
    assert jaccard._sieved(docs, "a.key", docs.filter("`a.key` is null")).filter("`a.key` is null").count() == 1
    assert jaccard._sieved(docs, "a.key", wanted.limit(0)).count() == 0
