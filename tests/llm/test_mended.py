"""Base results against brute force, very long runs, and what a language model's probabilities add up to."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabprep.llm import language_model, queries
from tabprep.llm.language_model import CLASSES, LogBilinear, Scorer, score_texts
from tabprep.llm.mix import mix
from tabprep.llm.pii import find_spans
from tabprep.llm.quality import judge

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").toPandas()


def run(spark, n):
    label = next(k for k in queries.QUERIES if k.startswith(f"op{n}_"))
    return queries.QUERIES[label](spark, DATA).toPandas()


# ---- personal data

def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text):
    return [(kind, m.start(), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(kind, m[0])]


def test_base_spans_against_brute_force(spark, documents):
    got = run(spark, 7).set_index("doc_id")
    for r in documents.itertuples():
        want = base_spans(r.text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        row = got.loc[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in want) for k in PATTERNS]
        assert set(joined.split(",")) <= set(row.spans.split(","))


def long_texts(n):
    return {
        "digits": "7" * n, "spaced": "4 " * n, "dashes": "4-" * n, "domain": "a@b" + ".c" * n, "local": "a" * n, "dots": "1." * n,
        "plus": "+1" * n, "phone": "+1" + " " * n, "ats": "a@" * n, "dotted": "." * n, "spelled": "x (at) y (dot) " * (n // 8)}


def test_spans_in_long_runs(spark):
    """Short enough for the plain search, then long enough to overflow a recursive one."""
    rows = list(enumerate(long_texts(600).values()))
    for r in find_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "base").collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == base_spans(rows[r.doc_id][1])
    n = 100_000
    texts = long_texts(n)
    found = find_spans(spark.createDataFrame(list(texts.items()), "doc_id string, text string"))
    got = {r.doc_id: r for r in found.select("doc_id", F.size("base").alias("n"), F.get("base", F.lit(0)).alias("first")).collect()}
    assert (got["domain"].n, got["domain"].first.end) == (1, 2 * n + 3) and got["dots"].n == n // 4
    assert all(got[k].n == 0 for k in texts if k not in ("domain", "dots"))


# ---- quality

def test_columns_may_be_called_as_those_of_a_profile(spark, documents):
    docs = spark.createDataFrame(documents)
    plain = judge(docs).select("doc_id", "kept").collect()
    clash = docs.withColumns({"common": F.lit(1), "char_shares": F.lit(2), "word_shares": F.lit("x"), "total": F.lit(3)})
    got = judge(clash)
    assert set(clash.columns) <= set(got.columns) and got.filter("common = 1 and word_shares = 'x'").count() == len(documents)
    assert sorted(got.select("doc_id", "kept").collect()) == sorted(plain)


def test_texts_without_common_words_are_rejected_in_every_language(spark, documents):
    strange = [(10_000 + i, " ".join(f"qx{i}z{j}j" for j in range(200)), lang) for i, lang in enumerate(sorted(documents.lang.unique()))]
    both = spark.createDataFrame(documents[["doc_id", "text", "lang"]]).union(spark.createDataFrame(strange, "doc_id bigint, text string, lang string"))
    got = {r.doc_id: r for r in judge(both).collect()}
    judged = [got[i] for i, _, _ in strange if got[i].word_distance is not None]
    assert judged and all(not r.base_failed and not r.kept for r in judged)


# ---- language model

def test_class_probabilities_add_up_to_one():
    model = LogBilinear.fresh(np.full(CLASSES, 1 / CLASSES), seed=4)
    model.near, model.context = model.near + 0.3, model.context * 5
    score = Scorer(model)
    for context in (0, 77, (CLASSES + 1) ** 2 - 1):
        assert np.power(10.0, score(np.full(CLASSES, context), np.arange(CLASSES))).sum() == pytest.approx(1.0, rel=1e-5)


def test_weighted_rows_train_like_repeated_ones():
    rng = np.random.default_rng(0)
    code, n = np.arange(40) * 1000 + 7, rng.integers(1, 200, 40).astype(float)
    noise = np.full(CLASSES, 1 / CLASSES)
    one, many = (LogBilinear.fresh(noise) for _ in "ab")
    for turn in range(10):
        one.train(code, n, noise, turn, 1.0)
        many.train(np.repeat(code, n.astype(int)), np.ones(int(n.sum())), noise, turn, 1.0)
    a, b = (Scorer(m)(code // CLASSES, code % CLASSES) for m in (one, many))
    assert min(a.mean(), b.mean()) > -np.log10(CLASSES) + 0.5 and abs(a.mean() - b.mean()) < 0.5


def test_gain_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = score_texts(docs).filter("held_out").agg(F.sum("n_tokens"), F.sum("base_score"), F.sum("score")).first()
    assert held[2] / held[0] > held[1] / held[0] + 0.4                     # log10 a token


# ---- mixing

def test_mix_meets_its_targets(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    got = queries.QUERIES["op9_splitting_tree_mix"](spark, folder).toPandas()
    size = {r.doc_id: len(re.findall("[^\x20\x09-\x0D]+", r.text or "")) for r in documents.itertuples()}
    source = dict(zip(documents.doc_id, documents.source))
    totals = {}
    for i, n in size.items():
        totals[source[i]] = totals.get(source[i], 0) + n
    open_, left, target = sorted(totals), sum(totals.values()), {}
    weight = {s: 1 + i % 3 for i, s in enumerate(open_)}
    while True:                                                            # stop what is above, share the rest again
        each = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * each > 3 * totals[s]]
        if not above:
            break
        for s in above:
            target[s] = 3 * totals[s]
            left -= target[s]
        open_ = [s for s in open_ if s not in above]
    target.update({s: weight[s] * each for s in open_})
    assert (got["size"] == got.doc_id.map(size)).all() and (got.taken <= 3 * got["size"]).all()
    taken = got.groupby(got.doc_id.map(source)).taken.sum()
    for s in totals:
        assert got.target[got.doc_id.map(source) == s].iloc[0] == pytest.approx(target[s])
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 50
    copies = got.shards.map(lambda v: len(v.split(",")) if v else 0)
    assert (copies * got["size"] == got.taken).all() and set(",".join(got.shards[copies > 0]).split(",")) <= set("01234567")
    again = mix(spark.createDataFrame(documents).select("doc_id", "source", F.lit(5).cast("bigint").alias("size")).limit(0))
    assert again.collect() == []


def test_distinct_words_are_hashed_once(monkeypatch):
    """Every token was hashed or looked up by itself."""
    texts = ["", None, "  ", "a", " A\x0bb\x0c\x1cc\td\ne\rf  ", "".join(map(chr, range(1, 300))), "\u00c9 \u00e9  x y", "end " * 500]
    seen, real = [], language_model.xxhash.xxh64_intdigest
    monkeypatch.setattr(language_model.xxhash, "xxh64_intdigest", lambda w: seen.append(w) or real(w))
    hashes, tokens, ends = language_model._tokens(pa.array(["unread", *texts])[1:])
    wanted = [(text or "").encode().lower().split() for text in texts]
    flat = np.array([h for words in wanted for h in [*map(real, words), language_model.END_HASH]], np.uint64).view(np.int64)
    assert hashes[tokens].tolist() == flat.tolist() and ends.tolist() == np.cumsum([0] + [len(w) + 1 for w in wanted]).tolist()
    assert len(seen) == len(set(seen))
