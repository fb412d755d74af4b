"""Posting lists against brute force; main text of pages; the whole pipeline."""

import html
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from starload.llm import main_text, posting_lists
from starload.llm.common import read_table

from .conftest import SF

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in {i for i in ids if i % 20 == 0}:
        s = x @ x[np.flatnonzero(ids == q)[0]]
        order = [j for j in np.lexsort((ids, -s.round(12))) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_and_order(spark):
    table = read_table(spark, SF, "embeddings")
    expected = brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    found = {}
    for r in posting_lists.op3_posting_lists(spark, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(expected)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in e}) for q, e in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))
    for q, rows in found.items():
        assert len(rows) == len(expected[q]) and rows == sorted(rows, key=lambda r: (-round(r[1], 12), r[0]))


def test_hot_vector_small_parts_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[100:250] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, VECTORS)
    index = posting_lists.Index(part=16, block=4, probe=3.0, beam=512)
    found = {}
    for r in posting_lists.nearest(table, F.col("vec_id") % 20 == 0, index).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q, expected in brute(rows).items():
        got = [found[q][k] for k in range(1, 21)]
        assert [i for i, _ in got] == [i for i, _ in expected]
        assert np.allclose([s for _, s in got], [s for _, s in expected])


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [-1.0, 0.0])]
    table = spark.createDataFrame(rows, VECTORS).withColumn("vector", F.lit("x")).withColumn("list", F.lit(1))
    got = posting_lists.nearest(table, F.col("vec_id") % 20 == 0).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == {
        (0, 1, 1, 1.0), (0, 2, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0)
    }
    assert posting_lists.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_graph_search_finds_the_nearest_centroids(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 12))
    entries = spark.createDataFrame([(v.tobytes(), float(v @ v)) for v in x], "vector binary, norm double")
    c = posting_lists.fit_centroids(entries, 12, posting_lists.Index(centroids=64))
    q = posting_lists.lifted(x[:100], c.bound)
    numbers, d = c.nearest(q, 16)
    exact = np.sort(posting_lists.distances(q, c.centres), axis=1)
    assert np.allclose(d[:, 0], exact[:, 0]) and (np.abs(d[:, :4] - exact[:, :4]) < 1e-9).mean() > 0.95
    assert all(len(set(n)) == len(n) for n in numbers)


def test_recall_over_vectors_of_mixed_norms(spark):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(200, 64))
    x = middles[rng.integers(0, 200, 20_000)] + 0.8 * rng.normal(size=(20_000, 64))
    x *= (rng.uniform(0.2, 3.0, len(x)) / np.linalg.norm(x, axis=1))[:, None]
    ids = np.arange(len(x))
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    got = {}
    for r in posting_lists.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, len(x), 100):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(got[q] & set(ids[np.argpartition(-s, 20)[:20]].tolist()))
    assert hits >= 0.97 * 20 * len(got) and len(got) == 200


# Pages


def article(page):
    body = re.search(r"<article>(.*)</article>", page or "", re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>|<br>", re.sub(r"</?b>", "", body))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_articles_of_all_pages(spark):
    pages = {r["page_id"]: r for r in read_table(spark, SF, "pages").collect()}
    found = main_text.op5_main_text(spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


def test_markup_of_many_kinds():
    page = """<!doctype html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><nav><a href="/">Home</a></nav>
    <main><h1 class="header">The title</h1><p>One &amp; two<br>three <b>bold</b>  text&nbsp;here <!-- no --> end
    <p>Second > first<div class="adBox">Buy</div><div class='post-body'><ul><li>item<li>next</ul></div>
    <script>var x = "</p>";</script><form><label>Mail</label><input></form>
    <section class="comments"><p>Nice!</p></section><p>Last&hellip;</p></main>
    <aside>More</aside><footer>(c)</footer>"""
    text = main_text.page_texts([page], main_text.Pages())[0]
    assert text == "The title\nOne & two three bold text here end\nSecond > first\nitem\nnext\nLast…"
    assert main_text.page_texts([None, "", "<p>", "plain <b>text"], main_text.Pages()) == ["", "", "", "plain text"]


def test_open_blocks_lose_what_the_host_repeats():
    template = "<div>Read all the news of the day here first</div>"
    pages = [f"<body>{template}<div>{i} only on this page {i * 7} times</div></body>" for i in range(12)]
    texts = main_text.page_texts(pages, main_text.Pages())
    assert texts == [f"{i} only on this page {i * 7} times" for i in range(12)]
    assert main_text.page_texts(pages[:1] * 12, main_text.Pages())[0].startswith("Read all")  # copies of one page
    kept = main_text.page_texts([p.replace("body>", "article>") for p in pages], main_text.Pages())
    assert kept[3] == "Read all the news of the day here first\n3 only on this page 21 times"


def test_open_blocks_beside_an_article_stay_unless_repeated():
    template = "<div>Read all the news of the day here first</div>"
    pages = [f"<article>teaser {i}</article>{template}<div>{i} stands only on this page {i * 7} times</div>" for i in range(12)]
    texts = main_text.page_texts(pages, main_text.Pages())
    assert texts == [f"teaser {i}\n{i} stands only on this page {i * 7} times" for i in range(12)]


def test_shared_words_in_running_text_stay():
    pages = [f"<div>page {i} says that the cat sat on the mat again and then {i} goes on with its own {i} words, {i} of them here and {i} there</div>" for i in range(5)]
    texts = main_text.page_texts(pages, main_text.Pages())
    assert texts == [re.sub("<.*?>", "", p) for p in pages]


def test_notice_of_a_section_goes_on_a_large_host():
    notice = "<div>All rights of this section are held by its authors alone</div><div>Read it in the morning paper</div>"
    pages = [f"<div>{' '.join(f'w{i}x{j}' for j in range(9))}</div>" + notice * (i < 40) for i in range(500)]
    texts = main_text.page_texts(pages, main_text.Pages())
    assert texts == [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(500)]


def test_markup_that_ends_by_itself():
    def text(page):
        return main_text.page_texts([page], main_text.Pages())[0]

    assert text('<article><p>One</p><svg class="i"/><p>Two</p></article>') == "One\nTwo"
    assert text('<article><p>One<svg><path d="M0"/></svg> more</p><p>Two</article>') == "One more\nTwo"
    assert text("<article><p>One</p><!-- <script src=x> --><p>Two</p><!--><p>Th<!-- x -->ree</p></article>") == "One\nTwo\nThree"
    assert text('<article><p title="<!-- <script>">One</p><p>Two</p></article>') == "One\nTwo"
    assert text('<article><p class="ad">Buy<p>Real text<p>More</article>') == "Real text\nMore"
    assert text('<article><ul><li class="ad">Buy<p>it<li>Real<ul><li class="ad">Buy</ul>item<li>Last</ul></article>') == "Real\nitem\nLast"
    assert text('<article><table><tr class="ad"><td>Buy<tr><td class="ad">Buy<td>Real</table></article>') == "Real"
    assert text('<article><div class="ad"><p>Buy<p>it</div>Real</article>') == "Real"


def test_suffix_ranks_equal_brute_force():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 3, 200)
    ranks = main_text.run_ranks(tokens, 6)
    runs = [tuple(tokens[i : i + 6]) for i in range(195)]
    order = np.argsort(ranks[:195], kind="stable")
    assert [runs[i] for i in order] == sorted(runs)
    assert len(set(ranks[:195])) == len(set(runs))


def test_page_edge_cases(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
    rows = [(1, None, None), (2, "x", ""), (3, None, "<p>hello"), (3, None, "<p>hello"), (None, "http://a/", "<p>x"), (4, "http://h", "<p>" + "w " * 50_000)]
    table = spark.createDataFrame(rows, schema).withColumn("host", F.lit(1)).withColumn("text", F.lit(2))
    found = main_text.main_texts(table).collect()
    assert Counter((r["page_id"], r["text"][:5]) for r in found) == Counter({(1, ""): 1, (2, ""): 1, (3, "hello"): 2, (None, "x"): 1, (4, "w w w"): 1})
    assert main_text.main_texts(table.limit(0)).count() == 0


def test_texts_do_not_depend_on_the_size_of_groups(spark):
    notice = "<div>All rights of this part are held by its authors alone</div>"
    pages = [f"<div>{' '.join(f'w{i}x{j}' for j in range(9))}</div>" + notice * (i < 3) for i in range(40)]
    rows = [(i, "http://h/a" if i % 2 or i < 4 else "http://closed/", p) for i, p in enumerate(pages)]
    rows += [(40 + i, "http://copies/", rows[0][2]) for i in range(5)] + [(50, "http://h/b", f"<article>x</article><nav>{notice}</nav>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    alone = {h: [r for r in rows if r[1].startswith(h)] for h in ("http://h/", "http://closed/", "http://copies/")}
    wanted = {}
    for own in alone.values():
        wanted |= dict(zip([r[0] for r in own], main_text.page_texts([r[2] for r in own], main_text.Pages()), strict=True))
    assert "All rights" not in wanted[0] and "All rights" in wanted[40]
    for size in (1, 300, 4 << 20):
        found = main_text.main_texts(table, main_text.Pages(group_bytes=size))
        assert {r["page_id"]: r["text"] for r in found.collect()} == wanted


def test_pages_without_open_blocks_go_through_the_suffix_array_too(spark):
    menu = "<nav>Home and news and sport and all the rest of the paper</nav>"
    rows = [(i, f"http://closed{i % 2}/{i}", f"{menu}<aside>w{i}</aside><article>text {i}</article>") for i in range(12)]
    rows += [(20 + i, "http://closed0/", f"<article>other {i}</article>{menu}<aside>w0</aside>") for i in range(50)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    streams = table.selectExpr("page_id", "url", "split_part(url, '/', 3) AS host", "html")
    for size in (40, 4 << 20):
        pages = main_text.Pages(group_bytes=size)
        dealt = main_text.dealt_streams(streams, pages)
        assert dealt.count() == 12  # pages that differ in their articles alone have one stream
        runs = main_text.counted_runs(dealt, pages).groupBy("host", "run").agg(F.sum("pages").alias("n")).where("n >= 3")
        assert Counter(r["host"] for r in runs.collect()) == {"closed0": 7, "closed1": 7}
        found = main_text.main_texts(table, pages)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" not in plan and "FlatMapCoGroupsInArrow" in plan
        wanted = {r[0]: r[2].split("<article>")[1].split("</article>")[0] for r in rows}
        assert {r["page_id"]: r["text"] for r in found.collect()} == wanted and found.count() == len(rows)


# Pipeline


def test_pipeline_runs_over_all_documents(spark):
    docs = read_table(spark, SF, "documents")
    rules = corpus_pipeline.keep_by_rules(spark, docs, SF)
    labels = {r["doc_id"]: r for r in read_table(spark, SF, "labels").collect()}
    dropped = {r[0] for r in docs.select("doc_id").subtract(rules.select("doc_id")).collect()}
    short = {r[0] for r in docs.where(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) < 20).select("doc_id").collect()}
    assert all(labels[i]["quality"] == 0 for i in dropped - short if i in labels)
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    assert rows and {r["doc_id"] for r in rows} <= {r[0] for r in docs.select("doc_id").collect()} - dropped
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_copies", "mixing", "bpe"]
