"""The pipeline's stages on the small tables."""

from __future__ import annotations

import collections

import corpus_pipeline
from pyspark.sql import functions as F
from tabprep.llm.mix import mix

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").persist()
    counts, now = [docs.count()], docs
    for label, stage in corpus_pipeline.STAGES[:4]:
        before, now = now, stage(spark, now, DATA).persist()
        assert now.columns == docs.columns
        assert now.join(before, "doc_id", "left_anti").count() == 0
        counts.append(now.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    placed = corpus_pipeline.STAGES[4][1](spark, now, DATA)
    assert placed.count() == counts[4]


def linked(a, b):
    one, two = ({tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(one & two) * 10 >= len(one | two) * 8


def test_null_and_repeated_ids_against_brute_force(spark):
    def text(n, tail=""):
        return " ".join(f"w{n}x{i}" for i in range(60)) + tail
    rows = [
        (1, text(1), "a"), (1, text(1), "a"), (1, text(1), "a"), (2, text(1, " more"), "b"), (None, text(1, " again"), "b"),
        (None, text(2), "a"), (None, text(2), "a"), (None, text(2, " more"), "b"), (None, text(3), None),
        (5, text(4), "b"), (5, text(5), "b"), (5, text(6, " more"), "a"), (6, text(6), "a"), (7, text(7), None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3).persist()
    left = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    groups = []                                              # links of these texts are transitive
    for row in left:
        own = next((g for g in groups if linked(g[0][1], row[1])), None)
        groups.append([row]) if own is None else own.append(row)
    got = corpus_pipeline.near_duplicates(spark, docs, DATA).collect()
    assert len(got) == len(groups)
    for group in groups:
        found = [r for r in got if linked(r.text, group[0][1])]
        assert len(found) == 1 and found[0].doc_id == group[0][0] and tuple(found[0]) in group

    sized = docs.withColumn("size", F.size(F.split("text", " ")).cast("bigint")).withColumn("t", F.xxhash64("text"))
    wanted = collections.Counter()
    for r in mix(sized, keep=("t",)).join(sized.select("t", "text").distinct(), "t").collect():
        wanted[r.doc_id, r.text, r.source] += len(r.shards)
    taken = collections.Counter(tuple(r) for r in corpus_pipeline.source_mix(spark, docs, DATA).collect())
    assert any(k[0] is None for k in taken) and sum(taken.values()) == sum(wanted.values())
    held = collections.Counter(rows)
    assert all(0 < n <= 3 * held[row] for row, n in taken.items())
    assert sum(len(r[1].split()) * n for r, n in taken.items()) == sum(len(r[1].split()) * n for r, n in wanted.items())
