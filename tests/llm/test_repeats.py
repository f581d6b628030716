"""Removal of repeated passages: many blocks and buckets against brute force, and the disk it takes."""

from __future__ import annotations

import os

import numpy as np
import pytest

from tabprep.llm import suffixes
from tabprep.llm.suffixes import remove_repeats
from tabprep.session import shared_dir


def made(rng, n, share, words=4000, size=600):
    """Texts of random words, ``share`` of which hold a passage of 100 words from a small pool."""
    vocabulary = np.array(["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 9))) for _ in range(words)])
    pool = [list(vocabulary[rng.integers(0, words, 100)]) for _ in range(n // 20 + 1)]
    for _ in range(n):
        text = list(vocabulary[rng.integers(0, words, size)])
        if rng.random() < share:
            text[50:50] = pool[rng.integers(0, len(pool))]
        yield " ".join(text)


def brute(rows, length):
    """(key, removed bytes, spans) of each row: a window goes if a smaller key has it, a null key is the largest."""
    rank = [suffixes.LAST if k is None else k for k, _ in rows]
    first = {}
    for k, (_, text) in sorted(zip(rank, rows), key=lambda x: x[0]):
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            first.setdefault(data[p:p + length], k)
    out = []
    for k, (key, text) in zip(rank, rows):
        data, runs = (text or "").encode(), []
        for p in range(len(data) - length + 1):
            if first[data[p:p + length]] < k:
                if runs and p <= runs[-1][1]:
                    runs[-1][1] = p + length
                else:
                    runs.append([p, p + length])
        out.append((-1 if key is None else key, sum(b - a for a, b in runs), runs))
    return sorted(out)


@pytest.mark.parametrize("length", [28, 50])
def test_blocks_and_buckets_against_brute_force(spark, monkeypatch, length):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", (2000, 2000))
    monkeypatch.setattr(suffixes, "PART_BYTES", 5000)
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 3000)
    monkeypatch.setattr(suffixes, "BUCKET_ROWS", 50)
    monkeypatch.setattr(suffixes, "BROADCAST_ROWS", 0)
    rng = np.random.default_rng(1)
    texts = list(made(rng, 60, 0.7, size=80))
    rows = [(int(k), t) for k, t in zip(rng.permutation(60), texts)]
    rows += [(100, texts[3]), (-5, texts[4]), (7, texts[5]), (7, texts[5]), (None, texts[6][20:]), (None, texts[7]), (None, None), (8, ""), (9, "short"),
             (101, "short"), (102, "ab" * 200), (103, "b" + "ab" * 60), (104, "\0" * 70), (105, "\0" * 51 + "x"), (106, "ä€" * 40), (107, "€ä" * 40),
             (108, texts[8] + texts[9]), (109, texts[9][:60] + "|" + texts[9][60:])]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), length=length).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_removed, [list(s) for s in r.spans]) for r in got)
    assert found == brute(rows, length) and sum(n for _, n, _ in found) > 5000


def test_pieces_of_ranges_and_buckets_make_no_difference(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [t.encode() for t in made(rng, 40, 0.8, size=120)]
    rows = [{"block": b, "ids": list(range(b, 40, 4)), "sizes": [len(t) for t in texts[b::4]], "copies": None,
             "text": suffixes._packed(np.frombuffer(b"".join(texts[b::4]), np.uint8))} for b in range(4)]
    asked = [x for row in rows for out in suffixes._keys(1, 1)(suffixes._Block(row, 50), row) for x in out.to_pylist()]

    def solved(part, of):
        return sorted(map(repr, (x for out in of(0, [dict(x) for x in part]) for x in out.to_pylist())))

    whole = solved(asked, suffixes._shared(1))
    bits = {x["block"]: x for out in suffixes._shared(1)(0, [dict(x) for x in asked]) for x in out.to_pylist() if x["block"] is not None}
    none = np.empty(0, f"S{suffixes.GRAM}")
    contexts = [x for row in rows for out in suffixes._contexts(1, none)(suffixes._Block(row, 50), row | {"shared": [bits[row["block"]]]}) for x in out.to_pylist()]
    pairs = solved(contexts, suffixes._solve(50))
    assert len(pairs) == 4
    monkeypatch.setattr(suffixes, "MERGE_KEYS", 7)
    monkeypatch.setattr(suffixes, "SOLVE_ROWS", 5)
    assert solved(asked, suffixes._shared(1)) == whole and solved(contexts, suffixes._solve(50)) == pairs


def test_keys_are_spread_evenly_over_ranges():
    rng = np.random.default_rng(3)
    _, hashes = suffixes.anchors(rng.integers(97, 123, 200_000).astype(np.uint8).tobytes(), 50)
    counts = np.bincount(suffixes.keyed(hashes) * 8 >> suffixes.KEY_BITS, minlength=8)
    assert counts.max() < 1.2 * counts.min()


def disk(spark):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()] + [shared_dir(spark)]
    return {os.path.join(at, f) for d in folders for at, _, files in os.walk(d.removeprefix("file:")) for f in files}


def test_a_table_beyond_the_broadcasts_takes_little_disk(spark, monkeypatch, tmp_path):
    for limit in ("BROADCAST_KEYS", "BROADCAST_ROWS", "BROADCAST_BYTES"):           # as with a table of some GB
        monkeypatch.setattr(suffixes, limit, 0, raising=False)
    rows = list(enumerate(made(np.random.default_rng(4), 2000, 0.9, words=300)))
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/docs")
    size = sum(os.path.getsize(f"{tmp_path}/docs/{f}") for f in os.listdir(f"{tmp_path}/docs"))
    before = disk(spark)
    remove_repeats(spark.read.parquet(f"{tmp_path}/docs")).select("doc_id", "n_removed").write.parquet(f"{tmp_path}/out")
    assert sum(os.path.getsize(f) for f in disk(spark) - before) < 4 * size
