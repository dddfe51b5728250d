"""Vector and page operators against brute force, the SQL twins, and the pipeline's stages."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from strataline.llm import op2_embeddings, op3_bitsliced, op7_content, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 6))
    near = base[rng.integers(0, 40, 80)] + 0.08 * rng.normal(size=(80, 6))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate((base, near)))]
    rows += [(200, rows[7][1]), (201, None), (202, []), (203, [0.0] * 6), (204, [1.0, None] * 3), (205, [float("nan")] * 6),
             (206, [1.0, 2.0]), (207, [2.0, 4.0]), (208, [float("inf")] * 6), (None, rows[7][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_near_vectors(vectors):
    rows, frame = vectors
    good = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    cos = {(i, j): np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) for i, a in good for j, b in good if len(a) == len(b) and i != j}
    component = {i: i for i, _ in rows if i is not None}
    for _ in rows:
        for (i, j), c in cos.items():
            if c >= 0.95:
                component[i] = component[j] = min(component[i], component[j])
    want = {i: (sum(c >= 0.95 for (a, _), c in cos.items() if a == i), component[i]) for i in component}
    got = op2_embeddings.near_duplicates(frame, interval=16).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_top_vectors(vectors):
    rows, frame = vectors
    good = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for q, a in good:
        if q % 50 == 0:
            scored = sorted((-int(a @ b), i) for i, b in good if i != q and len(a) == len(b))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, op3_bitsliced.top_k(frame, F.col("vec_id") % 50 == 0).collect())) == sorted(want)


def test_top_vectors_with_large_components(spark):
    rng = np.random.default_rng(2)
    values = [rng.normal(size=4).tolist() for _ in range(150)]
    values[7], values[50] = [70_000.0, 1.0, -2.0, 0.5], [-90_000.0, 3.0, 70_000.0, 0.0]
    values[60], values[100] = [3e9, -2e9, 1e3, 1.0], [2e12, 1.0, 1e12, 0.0]
    values[61], values[62] = [1e300, 0.0, 0.0, 0.0], [-3e16, 2e16, 0.0, 1.0]
    rows = list(enumerate(values))
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i != 61]
    want = []
    for q, a in good:
        if q % 50 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q]
            scored = sorted((s, i) for s, i in scored if -(1 << 63) <= -s < 1 << 63)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, op3_bitsliced.top_k(frame, F.col("vec_id") % 50 == 0).collect())) == sorted(want)


def test_main_text():
    weight = op7_content.DEFAULT
    words = "some words that make a longer paragraph of text "
    page = (f"<head><title>T</title><script>if(a<b)'</p>'</script></head><nav><a href=x>Home</a></nav><main><h1>A &amp; b</h1>"
            f"<p>{words}<b>bo</b>ld<p>{words}<div class='ad-box'><p>Buy now</p></div><p>{words}end.</main>"
            f"<section class=comments><p>Nice post</p></section><footer>&copy; foo</footer>")
    clean = words.strip()
    assert op7_content.extract(page, weight) == f"A & b {clean} bold {clean} {clean} end."
    assert [op7_content.extract(p, weight) for p in (None, "", "<p>", "<a ")] == [""] * 4


@pytest.mark.parametrize("opening", [
    '<div class="layout no-sidebar">', '<div id="page" class="has-header">', '<div class="post comments-open">',
    '<section class="share-enabled">', '<div class="sidebar">', '<div id=header><div class="widget">'])
def test_wrappers_named_like_chrome_keep_the_page(opening):
    words = "some words that make a longer paragraph of text " * 4
    chrome = '<div class="sidebar"><p>Related posts here</p></div><div class=comments><article><p>Nice</p></article></div>'
    for inner in (f"<article><h1>Top</h1><p>{words}</article>", f"<h1>Top</h1><p>{words}</p>"):
        page = f"<body>{opening}{inner}{chrome if '<article>' in inner else ''}</div></body>"
        assert op7_content.extract(page, op7_content.DEFAULT) == f"Top {words.strip()}"


WORDS = "some words that make a longer paragraph of text "
BODY = f"<p>{WORDS * 3}</p><p>{WORDS * 3}</p>"
CLEAN = " ".join([(WORDS * 3).strip()] * 2)
CHROME = ["reader-comments", "user-comments", "article-comments", "comment-thread", "related-posts", "related-articles",
          "share-buttons", "social-links", "nav-links", "cookiebanner", "google-ads", "readerComments", "site-footer", "post-sidebar",
          "newsletter-signup", "breadcrumb-trail"]


def _extracted(page):
    return op7_content.extract(page, op7_content.DEFAULT)


@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize("name", CHROME)
def test_named_chrome_goes_inside_and_outside_the_article(name, inside):
    part = f"<div class='{name}'><p>Nice post indeed, thank you</p><p>Read this as well</p></div>"
    article = f"<article>{BODY}{part if inside else ''}</article>{'' if inside else part}"
    assert _extracted(f"<body><div id=wrap>{article}</div></body>") == CLEAN
    # The same without an element that labels the content.
    assert _extracted(f"<body><div id=wrap>{BODY}</div>{part}</body>") == CLEAN


PAGES = {
    "form round the page": f"<body><form id=aspnetForm method=post><div>{BODY}</div></form></body>",
    "form round an article": f"<body><form method=post><nav><a href=x>Home</a></nav><article>{BODY}</article></form></body>",
    "form inside an article": f"<body><article>{BODY}<form><p>Your name please</p></form></article></body>",
    "aside and footer inside": f"<article>{BODY}<aside><p>More on this</p></aside><footer><p>Filed under x</p></footer></article>",
    "footer that holds all": f"<body><footer><div>{BODY}</div></footer></body>",
    "section of comments longer than the text": f"<body><article>{BODY}</article><section class=comments>{BODY * 3}</section></body>",
    "comments as articles": f"<body><article>{BODY}</article><div class=comments><article>{BODY * 2}</article></div></body>",
    "state of a post": f"<body><div class='post comments-open share-enabled'>{BODY}</div></body>",
    "page without a sidebar": f"<body class=no-sidebar><div class=no-sidebar>{BODY}</div></body>",
    "menu role": f"<body><div role=navigation><p>Home and about</p></div><main>{BODY}</main></body>",
    "script with markup": f"<article><script>document.write('<p>no</p>')</script>{BODY}</article>",
    "unclosed elements": f"<body><div><article>{BODY}<div class=related-posts><p>Other things",
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_pages_written_by_hand(name):
    assert _extracted(PAGES[name]) == CLEAN


def test_header_of_an_article_is_its_title():
    page = f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1></header>{BODY}</article></body>"
    assert _extracted(page) == f"Title {CLEAN}"


def test_deep_pages_take_linear_time():
    import time

    def seconds(n):
        start = time.process_time()
        assert _extracted("<div>" * n + "words here " * n + "</b></section>" * n) == " ".join(["words here"] * n)
        return time.process_time() - start

    seconds(1000)
    assert seconds(16_000) < 1.5  # 1.95 s for 8000 when every text walked the open elements


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), queries.ORACLES[name]) is None


def test_pipeline_stages(spark):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    import corpus_pipeline

    from strataline.llm.shared import stored

    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == before.columns
        seen.append((name, before.count(), docs.count()))
    assert seen[0][1] == seen[0][2] and seen[1][1] > seen[1][2] and seen[2][1] == seen[2][2]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= docs.count()
