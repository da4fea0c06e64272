"""Operators 3, 4, 5 and 10: held-out accuracy, exact expectations and recall."""

import html
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunefold.llm import ann, features, mainhtml, quality, toxicity, training
from tunefold.llm.queries import op4_max_subsequence_html, op10_kmeans_tree_neighbours

SF = "/root/testdata/sf0.01"


def _held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels.withColumn("rating", quality.rating()))
    rows = {r.doc_id: r for r in quality.rate(docs, model).collect()}
    known = [r for r in labels.collect() if _held_out(r.doc_id)]
    right = np.mean([rows[r.doc_id].selected == (r.quality == 1) for r in known])
    assert right > 0.93
    mean = lambda q, t: np.mean([rows[r.doc_id].expected_grade for r in known if (r.quality, r.toxic) == (q, t)])
    assert mean(0, 0) < mean(1, 1) < mean(1, 0)
    kept = {r.doc_id for r in quality.select(docs, model).collect()}
    assert kept == {i for i, r in rows.items() if r.selected}


def test_ordinal_fit_orders_its_thresholds():
    rng = np.random.default_rng(1)
    score = rng.normal(size=600)
    y = np.digitize(score, [-0.7, 0.2, 1.0])
    x = [np.flatnonzero(np.array([s < -1, s < 0, s > 0, s > 1])).astype(np.int32) for s in score]
    w, at = quality.fit(x, y, 4, 4)
    assert (np.diff(at) > 0).all() and w[0] < 0 < w[3]


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert all(r.held_out == _held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    known = [r for r in labels.collect() if _held_out(r.doc_id)]
    assert np.mean([rows[r.doc_id].predicted for r in known if r.toxic]) > 0.6
    assert np.mean([rows[r.doc_id].predicted for r in known if not r.toxic]) < 0.05


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, other)
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_risk_is_kept_from_falling_below_zero():
    """Unlabelled rows that are all positive: the plain corrected risk would push them down without end."""
    x = [np.array([0], np.int32)] * 40 + [np.array([0], np.int32)] * 40
    w, bias = toxicity.fit(x, np.r_[np.ones(40), np.zeros(40)], 1, 0.5)
    assert np.isfinite(w).all() and abs(w[0] + bias) < 5


def test_models_odd_rows(spark, docs_of):
    texts = [(1, None), (2, ""), (3, "x " * 60_000), (None, "idiot"), (5, "fine words"), (5, "fine words")]
    docs, none = docs_of(texts, score=1, tail="x"), docs_of([])
    labels = spark.createDataFrame([(5, 1, 1), (None, 1, 0), (3, None, None), (9, 0, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows) and {r.score for r in rows if r.doc_id == 1} == {r.score for r in rows if r.doc_id == 2}
    assert toxicity.score(none, model).count() == 0
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}
    rated = labels.withColumn("rating", quality.rating())
    model = quality.train(docs, rated)
    assert quality.rate(docs, model).count() == 6 and quality.rate(none, model).count() == 0
    assert quality.select(docs, model).columns == docs.columns
    assert quality.select(docs, quality.train(docs, rated.limit(0))).count() == 6


def test_features_of_long_texts_equal_those_in_one_block(monkeypatch):
    text = " ".join(f"word{i % 97}!" for i in range(4000)).encode()
    for style in ("words", "marks"):
        whole = [set(x.tolist()) for x in features.Features(style).of([text, b"", b"a b"])]
        monkeypatch.setattr(features, "BLOCK_BYTES", 500)
        assert [set(x.tolist()) for x in features.Features(style).of([text, b"", b"a b"])] == whole
        monkeypatch.undo()


def _article(page):
    x = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    x = re.sub(r"</?(b|i|em|strong|a|span)\b[^>]*>", "", x)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split())


def test_articles_of_all_pages(spark):
    want = {r.page_id: _article(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op4_max_subsequence_html(spark, SF).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


PRIOR = mainhtml.outside_kinds(mainhtml.prior())
P = " ".join(["plain"] * 12)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body>", ""),
        ("just words &amp; more", "just words & more"),
        (f"<nav><a>a</a> <a>b</a></nav><div><p>{P}</p><p>A&#233;&nbsp; b</p></div><footer>f</footer>", f"{P} Aé b"),
        (f"<div class='side-bar sidebar'>{P}</div><div>{P}<br>x<script>var a='</p>'</script></div>", f"{P} x"),
        (f"<main><h1>T</h1><p>{P}<aside>note</aside><form>in</form><p>e<b>n</b>d</main><p>{P} {P}", f"T {P} end"),
        (f"<article><p>{P}</p><div class=comments><p>{P} {P}</p></div></article>", P),
        (f"<p>{P}</p><!-- <p>gone</p> --><p title='a>b'>q</p><style>x", f"{P} q"),
        (f"<article><ul><li>one</li><li>two</ul>{P}", f"one two {P}"),
        (f"<header>{P}</header><p>{P} 1 < 2</p>", f"{P} 1 < 2"),
    ],
)
def test_main_text(page, text):
    assert mainhtml.main_text(page, PRIOR) == text


def test_html_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, None, ""), (None, "u", "<p>a b</p>"), (3, "v", "<p>" + "w " * 200_000)], "page_id long, url string, html string")
    pages = pages.withColumn("text", F.lit(1)).withColumn("kind", F.lit("x"))
    rows = mainhtml.extract(pages, mainhtml.learned(pages)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in rows) == [(0, 3), (1, 0), (1, 0), (3, 399_999)]
    assert mainhtml.extract(pages.limit(0), mainhtml.learned(pages.limit(0))).count() == 0


def _nearest(vectors, k=10):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((x - vectors[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def test_neighbours_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    want, got = _nearest(vectors), {}
    for r in op10_kmeans_tree_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, []).append(r)
        assert abs(r.score - np.sqrt(((vectors[r.query_id] - vectors[r.vec_id]) ** 2).sum())) < 1e-12
    assert set(got) == set(want)
    hits = 0
    for q, rows in got.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in rows] == sorted((r.score, r.vec_id) for r in rows)
        hits += len({r.vec_id for r in rows} & {i for i, _ in want[q]})
    assert hits / (10 * len(want)) >= 0.9


def test_neighbours_odd_rows(spark, monkeypatch):
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    same = [(i, [1.0, 2.0]) for i in range(100, 400)]
    df = spark.createDataFrame(bad + same, "vec_id long, embedding array<float>").withColumn("leaf", F.lit(1)).withColumn("shard", F.lit(1))
    monkeypatch.setattr(ann, "SHARD", 64)  # one vector's leaf is dealt to several shards
    rows = ann.nearest(df).collect()
    assert {r.query_id for r in rows} == {100, 200, 300} and all(r.score == 0 for r in rows)
    got = {q: [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in (100, 200, 300)}
    assert got == {100: list(range(101, 111)), 200: list(range(100, 110)), 300: list(range(100, 110))}
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id) for r in ann.nearest(few).orderBy("rank").collect()] == [(1, 1), (2, 1)]
    assert ann.nearest(df.limit(0)).count() == 0 and ann.nearest(df.where("vec_id < 3")).count() == 0


def test_best_bin_first_visits_every_leaf_once():
    rows = np.random.default_rng(1).normal(size=(3000, 6))
    tree = ann.Tree(rows)
    assert sorted(tree.search(rows[0], tree.leaves)) == list(range(tree.leaves))
    leaf = tree.assign(rows)
    assert all(tree.search(rows[i], 1) == [leaf[i]] for i in range(0, 3000, 100))
    assert 1 <= ann.calibrated(tree, rows, 10) <= tree.leaves


LONG = " ".join(f"long{i}" for i in range(60))


@pytest.mark.parametrize(
    "page, text",
    [
        # the only article is a teaser or a reader's comment
        (f"<main><h1>T</h1><p>{LONG}</p></main><article><p>{P}</p></article>", f"T {LONG}"),
        (f"<div><p>{LONG}</p></div><article><p>{P}</p></article>", LONG),
        (f"<main><p>{P}</p><article class='comment'><p>{LONG}</p></article></main>", P),
        (f"<div><p>{P}</p></div><article class='user-comment'><p>{LONG}</p></article>", P),
        # names of wrappers that sound like no content
        (f"<body class='social nav-open'><div class='page-with-sidebar'><h1>T</h1><p>{LONG}</p></div><footer>f</footer></body>", f"T {LONG}"),
        (f"<form id='ad'><p>{LONG}</p><div class='sidebar'>{P}</div></form>", LONG),
        (f"<nav>{LONG}</nav>", ""),
    ],
)
def test_scan_decides_over_marks_and_wrappers(page, text):
    assert mainhtml.main_text(page, PRIOR) == text


@pytest.mark.parametrize(
    "inner, text",
    [
        ("<figure><img src=x><figcaption>a caption</figcaption></figure>", "a caption"),
        ("<p>press <label>the label</label> now</p>", "press the label now"),
        ("<p>so <math><mi>x</mi><mo>+</mo><mn>1</mn></math> holds</p>", "so x+1 holds"),
        ("<p class='share-price'>up</p>", "up"),
        ("<p id='comment-on-budget'>kept</p>", "kept"),
        ("<h2 class='section-header'>kept</h2>", "kept"),
        ("<h2 id='skip-lists'>kept</h2>", "kept"),
        ("<h2 id=menu>kept</h2>", "kept"),
        ("<p id='widget-design'>kept</p>", "kept"),
        ("<section id='social-history'><p>kept</p></section>", "kept"),
        ("<section id='history-of-the-menu'><p>kept</p></section>", "kept"),
        ("<p data-id='comment' aria-role='nav'>kept</p>", "kept"),
        ("<div class='user-comment'>gone</div>", ""),
        ("<div class='comment-list'>gone</div>", ""),
        ("<ul id='comments_2'><li>gone</ul>", ""),
        ("<div class='share-buttons'>gone</div>", ""),
        ("<div class='box ad-slot-3'>gone</div>", ""),
        ("<p class='cookie-notice'>gone</p>", ""),
        ("<form><label>gone</label></form>", ""),
        ("<div role=navigation>gone</div>", ""),
    ],
)
def test_what_an_article_keeps(inner, text):
    assert mainhtml.main_text(f"<article><p>{P}</p>{inner}<p>{P}</p></article>", PRIOR) == " ".join(f"{P} {text} {P}".split())


def test_learned_scores_change_the_region(spark):
    """'notice' is a word of the list, yet the labelled pages use it for the text of their articles, and 'shelf' for what is none."""
    page = f"<div class='shelf'>{P} {P}</div><article><div class='notice'><p>{LONG}</p></div><p>{P}</p></article>"
    pages = [(i, "u", page) for i in range(400)]
    odd = f"<div><div class='notice'><p>{LONG}</p></div><div class='shelf'>{LONG.replace('long', 'shelved')}</div></div>"
    df = spark.createDataFrame([*pages, (999, "u", odd)], "page_id long, url string, html string")
    scores = mainhtml.learned(df)
    assert scores[".notice"] > 0 > scores[".shelf"] and PRIOR[".notice"] < 0
    assert mainhtml.main_text(odd, PRIOR) != LONG and mainhtml.main_text(odd, scores) == LONG
    assert mainhtml.main_text(page, PRIOR) == P and mainhtml.main_text(page, scores) == f"{LONG} {P}"


def _counted(page):
    """As ``counted``, word by word with the set of kinds around each."""
    p = mainhtml.Page(page)
    mark = p.settled(p.scores(PRIOR)[0])[0]
    found = {}
    for e, n in zip(p.at, p.words) if mark is not None else ():
        above, x = set(), e
        while x and not x <= mark <= p.last[x] or x == mark:
            above.update(p.kinds[x])
            x = p.up[x]
        for kind in above if n else ():
            found.setdefault(kind, [0, 0])[not mark <= e <= p.last[mark]] += n
    return {k: tuple(v) for k, v in found.items()}


def test_counts_of_kinds_equal_those_word_by_word(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(40).collect()]
    pages.append(f"<div class=a><div class='a b'>one <div class=b>two</div></div></div><article class=a>{LONG}<p class=a>x</p></article>")
    for page in pages:
        assert mainhtml.counted(page) == _counted(page)
    deep = "".join(f"<div class=c{i}>" for i in range(4000))
    assert mainhtml.counted(f"<article>{LONG}{deep}x</article>")[".c3999"] == (1, 0)


def test_weights_of_kinds_are_learned_from_marked_pages(spark):
    box = f"<div class='wrap'><div class='blurb'>{P}</div>"
    pages = [(i, "u", f"{box}<article class='story'><p>{LONG}</p></article></div>") for i in range(20)]
    pages += [(99, "u", f"{box}<div class='story'><p>{LONG}</p></div><div class='blurb'>{LONG}</div></div>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    scores = mainhtml.learned(df)
    assert scores[".story"] > mainhtml.WORD and scores[".blurb"] < 0 and ".wrap" not in scores
    assert {r.text for r in mainhtml.extract(df, scores).collect()} == {LONG}


def test_queries_in_tiny_leaves_get_all_their_rows(spark, monkeypatch):
    """Tight clusters of fewer rows than are asked for, and one leaf to visit."""
    rng = np.random.default_rng(3)
    rows = [(100 * i + j, [float(x) for x in 50 * c + rng.normal(size=4)]) for i, c in enumerate(rng.normal(size=(60, 4))) for j in range(5)]
    rows += [(0, rows[0][1])] * 4  # rows of its own don't fill a query's list
    monkeypatch.setattr(ann, "calibrated", lambda *a, **b: 1)
    monkeypatch.setattr(ann.Tree.__init__, "__defaults__", (8, 6))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.query_id: r["count"] for r in ann.nearest(df).groupBy("query_id").count().collect()}
    assert got == {100 * i: 10 for i in range(60)}


def test_samples_are_bounded_in_rows_where_ids_repeat(spark, monkeypatch):
    """A third of all rows share one id: a sample still has one row an id, the smallest text of it."""
    docs = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 5 else id end as doc_id",
        "case when id % 3 = 0 then concat('hot ', id) when id % 50 = 1 then null else concat('row ', id) end as text")
    ids = spark.createDataFrame([(5, 1), (5, 0), (1, 1), (7, 0), (99999, 1)], "doc_id long, target int")
    got = sorted((r["text"] or "", r["target"]) for r in training.sampled(docs, ids, "sample-test").collect())
    # id 5 has the rows 'hot 0', 'hot 3', ... and 'row 5'; 'hot 0' is the smallest
    assert got == [("", 1), ("hot 0", 0), ("hot 0", 1), ("row 7", 0)]
    monkeypatch.setattr(quality, "RATED", 40)
    counts = []
    monkeypatch.setattr(quality, "matrix", lambda sample, *a: counts.append(sample.count()) or training.matrix(sample, *a))
    rated = docs.selectExpr("doc_id", "cast(doc_id % 3 as int) as rating")
    quality.train(docs, rated)
    assert counts and counts[0] <= 40
