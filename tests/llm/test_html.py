"""Page parsing and alignment: against plain recursion, on malformed and very large pages, and the query itself."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from tabprep.llm import html_extract, queries
from tabprep.llm.html_extract import best_path, extract, extract_text, parse, skeleton, tree_match

DATA = "/root/testdata/sf0.001"
WORDS = "sun moon star tree leaf root hill lake bird song".split()


def nested(tree, i=0):
    at, kids = i + 1, []
    while at < i + tree["size"][i]:
        kids.append(nested(tree, at))
        at += tree["size"][at]
    return tree["label"][i], kids


def plain_match(a, b):
    """Simple tree matching as it is written in books."""
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain_match(x, y))
    return best[-1][-1] + 1


def random_page(rng, depth=0):
    kind = rng.choice(["div", "ul", "section", "table"])
    inner = "".join(random_page(rng, depth + 1) for _ in range(rng.randint(0, 4 - depth))) if depth < 4 else ""
    return f"<{kind} class={rng.choice('ab')}>{rng.choice(WORDS)} {inner}</{kind}>"


@pytest.mark.parametrize("table", [4_000_000, 2])
def test_tree_matching_is_as_good_as_plain_recursion(monkeypatch, table):
    monkeypatch.setattr(html_extract, "TABLE", table)          # 2: every list is solved in halves
    rng = random.Random(5)
    for _ in range(60):
        a, b = (skeleton(parse(f"<body>{''.join(random_page(rng) for _ in range(3))}</body>"))[0] for _ in "ab")
        score, pairs = tree_match(a, b)
        assert score == plain_match(nested(a), nested(b))
        assert len(set(p for p, _ in pairs)) == len(set(q for _, q in pairs)) == len(pairs)


def test_best_path_in_halves(monkeypatch):
    rng = np.random.default_rng(2)
    for _ in range(30):
        w = rng.integers(0, 4, (int(rng.integers(1, 12)), int(rng.integers(1, 12))))
        best = np.zeros((w.shape[0] + 1, w.shape[1] + 1), int)
        for i in range(w.shape[0]):
            for j in range(w.shape[1]):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + w[i, j])
        for table in (1, 10, 1000):
            monkeypatch.setattr(html_extract, "TABLE", table)
            path = sorted(best_path(*w.shape, w.__getitem__))
            assert sum(w[p] for p in path) == best[-1, -1]
            assert all(a < c and b < d for (a, b), (c, d) in zip(path, path[1:]))


@pytest.mark.parametrize("piece", [
    "<a ", "<", "</", "<a x=\"", "<a x='\"", "<a x=\">\" ", "<!-", "<!--", "<div>", "<b><p>", "</div>", "<p>x</q>", "<script>", "<td><tr>", "<![", "a>b",
    "<li><ul>", "<a class=\"b", "&amp", "<option>", "<div><x>"])
def test_time_grows_with_the_page(piece):
    def seconds(n):
        at = time.perf_counter()
        extract(piece * n, None)
        return time.perf_counter() - at

    seconds(1000)
    small, large = min(seconds(8000) for _ in range(3)), min(seconds(32000) for _ in range(2))
    assert large < 10 * small + 0.05                           # four times the page


def page(body, nav="Home Shop About", foot="All rights kept"):
    return f"<html><body><div class=x><p>{nav}</p></div>{body}<div class=y><p>{foot}</p></div></body></html>"


def test_article_behind_thousands_of_containers():
    items = "".join(f"<div class=c><ul><li>item {i}</li></ul></div>" for i in range(5000))
    text = "Long words of the article itself. " * 30
    other = skeleton(parse(page(items + "<div class=z><p>Something else altogether.</p></div>")))[0]
    got = extract(page(items + f"<div class=z><p>{text}</p></div>"), [other])
    assert got == text.strip()
    changed = items.replace("item 7", "thing 7")
    assert extract(page(changed + f"<article><p>{text}</p></article>"), [other]) == text.strip()


def test_very_deep_pages():
    deep = "<div>" * 30_000 + "the text" + "</div>" * 30_000
    assert extract(deep, None) == "the text"
    assert extract(deep, [skeleton(parse(deep.replace("the text", "another")))[0]]) == "the text"


def test_quotes_and_unfinished_tags():
    assert extract("<p title=\"a > b\">one</p><p data-x='<p>'>two</p>", None) == "one\ntwo"
    assert extract("<p>it's 1 < 2 & \"so\"</p><p title=don't>three</p>", None) == "it's 1 < 2 & \"so\"\nthree"
    assert extract("<p>one</p><p>two <b", None) == "one\ntwo <b"
    assert extract("<p>one<!-- never closed <p>two", None) == "one"


def test_query_on_its_table_and_odd_rows(spark):
    got = queries.QUERIES["op3_wrapper_induction"](spark, DATA).toPandas()
    rows = spark.read.parquet(f"{DATA}/pages.parquet").toPandas()
    assert sorted(got.page_id) == sorted(rows.page_id) and (got.n_chars == got.text.str.len()).all()
    assert (got.text.str.len() > 0).mean() > 0.9 and not got.text.str.contains("<p>").any()
    odd = [(1, None, None, 1), (None, "http://a.b/c", "<p>x</p>", 2), (3, "http://a.b/d", "", 3), (3, "http://a.b/d", "<p>y</p>", 3),
           (3, "http://a.b/d", "<p>y</p>", 3), (4, "no url", "<article>z &eacute;&#33;</article>", 4)]
    df = spark.createDataFrame(odd, "page_id bigint, url string, html string, host int")
    assert sorted((r.page_id or 0, r.text) for r in extract_text(df).collect()) == [(0, "x"), (1, ""), (3, ""), (3, "y"), (3, "y"), (4, "z é!")]
    assert extract_text(df.filter("page_id = 99")).collect() == []
