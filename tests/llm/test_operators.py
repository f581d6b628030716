"""The operators against brute force on the small tables, and on rows with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.llm import queries
from tabprep.llm.decontaminate import contamination
from tabprep.llm.draws import communication_matrix, hypergeometric, splitting_tree
from tabprep.llm.html_extract import extract, parse, skeleton, tree_match
from tabprep.llm.jaccard import fragment_keys, jaccard_classes, size_classes
from tabprep.llm.language_model import score_texts
from tabprep.llm.mix import mix
from tabprep.llm.pii import find_spans
from tabprep.llm.quality import judge
from tabprep.llm.shard import shard
from tabprep.llm.suffixes import remove_repeats
from tabprep.llm.toxicity import Trie, score_toxicity

DATA = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i}" for i in range(60))
ODD = [
    (1, None, "en", "a", 5), (2, "", None, None, 0), (3, LONG, "en", "a", 7), (3, LONG, "en", "a", 7), (4, LONG + " tail", "xx", "b", 7),
    (None, "lone text", "en", "b", 1), (5, " \t\n ", "de", "a", 1), (6, "mail me: x@y.com or +1 (555) 123-4567\n" * 3, "en", None, 1),
]
FIELDS = "doc_id bigint, text string, lang string, source string, kept int"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, FIELDS)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, n):
    label = next(k for k in queries.QUERIES if k.startswith(f"op{n}_"))
    return queries.QUERIES[label](spark, DATA).toPandas()


def test_draws_have_exact_margins():
    rng = random.Random(1)
    assert np.mean([hypergeometric(rng, 30, 70, 10) for _ in range(4000)]) == pytest.approx(3.0, abs=0.1)
    assert 0 < hypergeometric(rng, 10 ** 11, 10 ** 12, 10 ** 9) < 10 ** 9
    rows, columns = [5, 0, 9, 3], [6, 6, 5]
    matrix = communication_matrix(rng, rows, columns)
    assert [sum(r) for r in matrix] == rows and [sum(c) for c in zip(*matrix)] == columns
    tree = splitting_tree(rng, rows, columns)
    assert [sum(r) for r in tree] == columns and [sum(c) for c in zip(*tree)] == rows


def test_quality_counts(spark, texts):
    word = re.compile("[^\x20\x09-\x0D]+")
    for r in run(spark, 1).itertuples():
        text = texts[r.doc_id]
        w = word.findall(text)
        tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        seen, covered = collections.Counter(tri), set()
        for i, t in enumerate(tri):
            if seen[t] > 1:
                covered.update((i, i + 1, i + 2))
        lines = [x for x in text.split("\n") if word.search(x)]
        want = len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)


def test_repeats_are_cut_as_by_brute_force(spark, texts):
    first = {}
    for i in sorted(texts):
        data = texts[i].encode()
        for p in range(len(data) - 49):
            first.setdefault(data[p:p + 50], i)
    for r in run(spark, 2).itertuples():
        data = texts[r.doc_id].encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < r.doc_id:
                gone[p:p + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(data, gone) if not g)
        assert (r.n_removed, r.kept_sha256) == (sum(gone), hashlib.sha256(left).hexdigest())
        assert r.n_spans == sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(2)
    bounds, differ = size_classes(80)
    for n in [5, 9, 10, 17, 40, 100, 333, 900] * 6:
        a = rng.integers(0, 2 ** 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2)
        change = int(rng.integers(1, max(2, int(n * 0.115))))
        b = np.concatenate([a[change:], rng.integers(0, 2 ** 63, change, dtype=np.int64).astype(np.uint64)])
        if 100 * (n - change) >= 80 * (n + change):
            assert np.intersect1d(fragment_keys(np.unique(a), bounds, differ), fragment_keys(np.unique(b), bounds, differ)).size


def test_components_as_by_brute_force(spark, texts):
    sets = {}
    for i, text in texts.items():
        w = text.encode().lower().split()
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < 4 else zip(w, w[1:], w[2:], w[3:]))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = run(spark, 4)
    assert [(r.n_shingles, r.component_id) for r in got.itertuples()] == [(len(sets[r.doc_id]), find(r.doc_id)) for r in got.itertuples()]


def test_language_model_base_and_gain(spark, texts):
    tokens = {i: t.encode().lower().split() + [None] for i, t in texts.items()}
    counts = collections.Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(w)
    total, kinds = sum(counts.values()), len(counts)
    got = run(spark, 6)
    for r in got.itertuples():
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.train_tokens == total and r.score <= 0
        assert r.n_known == sum(counts[w] > 0 for w in tokens[r.doc_id])
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_shards_and_mix(spark):
    got = run(spark, 5)
    sizes = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert sizes["count"].max() - sizes["count"].min() <= 1 and (sizes["nunique"] == sizes["count"]).all() and (sizes["max"] == sizes["count"] - 1).all()
    mixed = run(spark, 9)
    assert (mixed.taken <= 3 * mixed["size"]).all()
    again = run(spark, 9)
    assert mixed.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    by_source = mixed.groupby(["source_size", "target"]).taken.sum().reset_index()
    assert by_source.target.sum() == pytest.approx(mixed["size"].sum())
    assert (abs(by_source.taken - by_source.target) <= 0.25 * by_source.target + 100).mean() > 0.8


def test_decontamination_with_short_items_and_shuffled_join(spark):
    bench = spark.createDataFrame([(1, LONG), (2, "Three short words"), (3, None), (4, "")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "x " + " ".join(LONG.split()[5:15]) + " y three SHORT words"), (2, " ".join(LONG.split()[5:14])), (3, None)], "doc_id int, text string")
    for bound in (1 << 20, 0):
        rows = {r.doc_id: (r.n_hit, r["items"]) for r in contamination(docs, bench, max_bytes=bound).collect()}
        assert rows == {1: (13, ["1", "2"]), 2: (0, []), 3: (0, [])}


def test_trie_search_and_toxicity(spark, odd):
    trie = Trie({"worthless": 3.0, "idiot": 2.0, "scum*": 1.0})
    assert trie.exact("scumbag") == 1.0 and trie.exact("idiots") is None
    assert trie.search("idoit") and trie.search("worthles") and trie.search("idiott") and trie.search("table") is None
    labels = spark.createDataFrame([(3, 0), (4, 1), (4, None), (6, 0)], "doc_id bigint, toxic int")
    assert score_toxicity(odd, labels).count() == len(ODD)
    assert 0 <= score_toxicity(odd, labels.limit(0)).agg(F.min("score")).first()[0] <= 1


def edits(text, letters="xz"):
    """All strings that are one edit away, swaps of neighbours included."""
    cut = [(text[:i], text[i:]) for i in range(len(text) + 1)]
    return ({a + b[1:] for a, b in cut if b} | {a + x + b for a, b in cut for x in letters} | {a + x + b[1:] for a, b in cut if b for x in letters}
            | {a + b[1] + b[0] + b[2:] for a, b in cut if len(b) > 1}) - {text}


def test_every_edit_of_every_term_and_stem_is_found():
    rng = random.Random(5)
    terms = {"".join(rng.choices("abcdefghijk", k=5 + i % 9)): 1.0 + i / 100 for i in range(120)}
    stems = {"".join(rng.choices("lmnopqrs", k=5 + i % 8)) + "*": 1.0 for i in range(40)}
    trie = Trie(terms | stems)
    for term in terms:
        assert all(trie.search(word) is not None for word in edits(term)), term
    for stem in stems:
        assert all(trie.search(word + "tttt") is not None for word in edits(stem[:-1])), stem
    for term in [t for t in terms if len(t) >= 10][:8]:
        for head in sorted(edits(term[:5])):
            assert all(trie.search(head + tail) is not None for tail in edits(term[5:])), (term, head)
    seed = Trie({"worthless": 3.0, "disgusting": 3.0})
    assert seed.search("wortlhess") and seed.search("xisgustinx") and seed.search("isgustin") and seed.search("wxorthlxess") is None


def test_page_text_and_tree_matching():
    page = ("<html><body><nav>menu</nav><div class='ad'>buy</div><article><h1>Title &amp; more</h1><p>one<br>two <b>three"
            "<p>four<script>x='</p>'</script><div class='comments'>no</div></article><footer>f</footer></body>")
    assert extract(page, []) == "Title & more\none two three\nfour"
    assert extract(None, None) == "" and extract("<p>just", []) == "just"
    other = skeleton(parse("<body><div>same text here</div><section>other words</section></body>"))[0]
    own = "<body><div>same text here</div><section>" + "my words " * 9 + "</section></body>"
    assert tree_match(skeleton(parse(own))[0], other)[0] == 4
    assert extract(own, [other]) == ("my words " * 9).strip()


@pytest.mark.parametrize("operator", [
    judge, shard, find_spans, lambda d: mix(d.withColumn("size", F.length("text"))), jaccard_classes, remove_repeats, score_texts,
    lambda d: contamination(d, d.selectExpr("doc_id as item_id", "text").where("doc_id = 3")),
], ids=["judge", "shard", "spans", "mix", "jaccard", "repeats", "model", "contamination"])
def test_odd_rows_and_empty_tables(odd, operator):
    assert operator(odd).count() == len(ODD)
    assert operator(odd.limit(0)).count() == 0
