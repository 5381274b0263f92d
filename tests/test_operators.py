"""Operators on small tables, sources and sinks, streams, and every query against its SQL."""

import json
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.functions import batches, embedding, html_blocks
from corpusloom.functions import text as TX
from corpusloom.functions import urls as U
from corpusloom.operators import crawl, dataset, manifest, pages, retrieval
from corpusloom.plans.exchange import ORACLE_SQL, QUERIES
from corpusloom.sources import jsonl, sinks
from corpusloom.streaming import stateful

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return [plain(x) for x in v] if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, DATA)
    got = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in ("pages", "documents", "embeddings", "labels", "benchmark", "events", "lineitem", "customer", "part", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        cols = ", ".join(f'"{c}"' for c in df.columns)
        want = con.execute(f"SELECT {cols} FROM ({ORACLE_SQL[name]})").fetchall()
        assert sorted((plain(tuple(r)) for r in got), key=repr) == sorted((plain(r) for r in want), key=repr)
    else:
        assert got


def test_urls(spark):
    m = [("https://en.wikipedia.org/wiki/Apple",), ("https://en.wikipedia.org/wiki/Talk:Apple",), ("http://en.wikipedia.org/wiki/Apple",), ("https://en.wikipedia.org/wiki/A#b",), ("https://en.wikipedia.org/wiki/A?action=edit",), (None,), ("x",), ("http://10.0.0.1/",)]
    u = F.col("url")
    df = spark.createDataFrame(m, "url string").select(U.is_article_url(u), U.domain_allowed(u, ["EN.wikipedia.org", "10.0.0.1"]), U.title_bucket(u, 26))
    assert [r[0] for r in df.collect()] == [True, False, False, False, False, False, False, False]
    assert [r[1] for r in df.collect()] == [True] * 5 + [False] * 3
    assert [r[2] for r in df.collect()] == [0, 19, 0, 0, 0, None, None, None]
    named = spark.createDataFrame([("https://en.wikipedia.org/wiki/Help:Zoo",)], "url string").select(U.title_bucket(u, 1000, True)).first()[0]
    assert named == 25 + 8 * 32
    assert spark.createDataFrame(m, "url string").where(U.domain_allowed(u, [])).count() == 0


def test_crawl(spark):
    p = spark.createDataFrame([(1, "http://a.com/x/y", '<a href="/1">1</a><a href="2">2</a><a href="http://b.com/#f">b</a><a href="mailto:x">m</a><a>n</a><a href="/1">again</a>'), (2, None, None)], "page_id bigint, url string, html string")
    links = crawl.extract_links(p)
    assert [r.link for r in links.orderBy("pos").collect()] == ["http://a.com/1", "http://a.com/x/2", "http://b.com/#f", "http://a.com/1"]
    assert [r.link for r in crawl.accept_links(links, ["a.com"], max_links=2).orderBy("pos").collect()] == ["http://a.com/1", "http://a.com/x/2"]
    assert tuple(crawl.crawl_metrics(p, links).select("fetched", "discovered", "enqueued", "duplicates").first()) == (2, 4, 3, 1)
    assert rows(crawl.bfs(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), (None, "z")], "s string, d string"), spark.createDataFrame([("a",), (None,)], "n string"), 2)) == [("a", 0), ("b", 1), ("c", 2)]
    counts = crawl.route_counts(links, 4, 2).agg(F.sum("local"), F.sum("remote")).first()
    assert sum(counts) == 4
    assert {r.depth for r in crawl.seed_tasks(spark, ["http://a.com/"], 4).collect()} == {0}


def test_links_of_long_pages_take_memory_by_their_own_bytes(spark):
    """A page of many links does not come with each of them: 200 pages of 0.2 MB with 2,000 links each would be 80 GB."""
    html = F.repeat(F.lit('<a href="/x">' + "y" * 80 + "</a>"), 2000)
    p = spark.range(200).coalesce(1).select(F.col("id").alias("page_id"), F.lit("http://a.com/").alias("url"), html.alias("html"))
    assert crawl.extract_links(p).count() == 400_000


def test_slices_of_batches():
    texts = ["a" * 10, None, "é" * 300, "", "b" * 2000, "c", "d" * 100]
    b = pa.RecordBatch.from_pydict({"i": list(range(7)), "t": texts})
    for size in (1, 200, 700, 1 << 20):
        got = list(batches.slices(iter([b, b.slice(2, 0), b.slice(3, 3)]), 1, size))
        assert [t for x in got for t in x.column(1).to_pylist()] == texts + texts[3:6]
        assert all(x.num_rows == 1 or sum(len((t or "").encode()) for t in x.column(1).to_pylist()) <= size for x in got)


@pytest.mark.parametrize("step", ["chunk_table", "english", "simple", "postings", "doc_chunks", "doc_paragraphs"])
def test_text_kernels_go_by_slices(spark, monkeypatch, step):
    """A batch of many rows reaches no kernel whole: with slices of 1 kB each gives its rows in several batches, and the same rows."""
    d = spark.range(400).coalesce(1).select("id", F.concat(F.lit("red fox "), F.repeat(F.lit("some word "), 20), "id").alias("text"))
    q = spark.createDataFrame([(1, "red fox"), (2, "word 7")], "query_id bigint, query string")
    run = {
        "chunk_table": lambda: sinks.chunk_table(d, ("id",)), "english": lambda: retrieval.lexical_english_scan(q, d), "simple": lambda: retrieval.lexical_simple(q, d), "postings": lambda: retrieval.postings(d),
        "doc_chunks": lambda: pages.doc_chunks(d, id_col="id"), "doc_paragraphs": lambda: pages.doc_paragraphs(d, id_col="id"),
    }[step]
    whole = rows(run())
    module = sinks if step == "chunk_table" else pages if step.startswith("doc") else retrieval
    marks = spark.sparkContext.accumulator(0)

    def small(bs, at, size=1000):
        for b in batches.slices(bs, at, size):
            marks.add(1)
            yield b

    monkeypatch.setattr(module, "slices", small)
    assert rows(run()) == whole and marks.value > 50


def test_words_of_a_long_text_are_held_a_piece_at_a_time(spark, monkeypatch):
    """The lists make up the text's words whatever the size; a text of 40 pieces gives the score of the whole one."""
    text = "red_fox, ünï9 " * 50 + "x" * 70 + " end"
    for size in (1, 7, 64, 1 << 20):
        lists = list(retrieval._word_lists(text, size))
        assert sum(lists, []) == retrieval._WORD.findall(text) and (size > 64 or all(len(x) <= size + 1 for x in lists))
    assert list(retrieval._word_lists("")) == []
    d = spark.createDataFrame([(1, text), (2, "Red fox end"), (3, "fox"), (4, ""), (5, None)], "id bigint, text string")
    q = spark.createDataFrame([(1, "red FOX end"), (2, "fox"), (3, "...")], "query_id bigint, query string")
    whole, cut = rows(retrieval.lexical_simple(q, d)), retrieval._word_lists
    monkeypatch.setattr(retrieval, "_word_lists", lambda t: cut(t, 16))
    assert rows(retrieval.lexical_simple(q, d)) == whole == rows(retrieval.lexical_simple(q, d, max_broadcast_bytes=0))


def test_arrow_batches_go_by_bytes(spark):
    """Of 300 rows of 0.1 MB a Python worker gets some 4 MB at once; a longer text is a batch of its own; what a session names stays."""

    def sizes(bs):
        for b in bs:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]})

    d = spark.range(300).coalesce(1).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 150, 6_000_000).otherwise(100_000)).alias("text"))
    key = session.ARROW_KEY
    session.ship(spark)
    got = d.mapInArrow(sizes, "n bigint, bytes bigint").collect()
    assert sum(r.n for r in got) == 300 and max(r.bytes for r in got) < 11_000_000 and sorted(r.bytes for r in got)[-2] < 4_500_000
    own = spark.newSession()
    own.conf.set(key, "12345678")
    assert session.ship(own).conf.get(key).rstrip("b") == "12345678"


def test_pages_without_html(spark):
    p = spark.createDataFrame([("http://a.b/", None), (None, "<p>x</p>"), ("http://en.wikipedia.org/wiki/X", "<body><h2>T</h2><p>y</p></body>")], "url string, html string")
    got = {r.url: r for r in pages.normalize_pages(p).collect()}
    assert got["http://a.b/"].error == "empty body" and got[None].body_text == "x"
    assert [b.heading_level for b in got["http://en.wikipedia.org/wiki/X"].blocks] == [1, None]
    assert pages.normalize_pages(p.limit(0)).count() == 0 and pages.wiki_blocks(p).count() >= 3


def test_all_blocks_of_a_long_page_count(spark):
    html = "<article><h1>T</h1>" + "".join(f"<p>w{i}</p>" for i in range(9000)) + "</article>"
    got = pages.normalize_pages(spark.createDataFrame([("http://a.b/", html)], "url string, html string"))
    assert pages.page_blocks(got).count() == 9001 and "w8999" in pages.page_chunks(got).orderBy(F.desc("chunk_id")).first().text
    assert len(html_blocks.normalize("u", html.encode(), max_blocks=3)["blocks"]) == 3


def test_references_without_a_semicolon(spark, tmp_path):
    """HTML decodes them; the queries, as their SQL, keep them: a title cut within a reference."""
    html = '<article><h1>a &amp; b&amp</h1>\n<p>x &quot;y&quot; &amp;quot; z &amp</p></article>'
    assert [b["text"] for b in html_blocks.normalize("u", html.encode())["blocks"]] == ["a & b&", 'x "y" &quot; z &']
    want = ["a & b&amp", 'x "y" &quot; z &amp']
    assert [b["text"] for b in html_blocks.normalize("u", html.encode(), closed_references=True)["blocks"]] == want
    assert html_blocks.close_references("&#38; &#x26; &nope; &copy &copy; a&b &") == "&#38; &#x26; &amp;nope; &amp;copy &copy; a&amp;b &amp;"
    spark.createDataFrame([(1, "http://a.b/", html)], "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name, at in (("page_blocks", "text"), ("page_chunks", "text"), ("embed_chunks", "embedding")):
        assert [r[0] for r in con.execute(f"SELECT {at} FROM ({ORACLE_SQL[name]}) ORDER BY ALL").fetchall()] == sorted(r[at] for r in QUERIES[name](spark, str(tmp_path)).collect())


def test_windows(spark):
    df = spark.createDataFrame([(1, [5, 6, 7, 8]), (2, []), (3, None)], "k int, ids array<int>")
    got = pages.inputs_and_targets(pages.lm_windows(df, "ids", 3))
    assert rows(got.select("k", "window_no", "window")) == [(1, 0, [1, 5, 6, 7]), (1, 1, [7, 8, 2, 0]), (2, 0, [1, 2, 0, 0])]
    assert got.where("k = 2").first().targets == [2, 0, 0]


def test_manifest(spark):
    f = spark.createDataFrame([("a", 1, 7), ("a", 2, 7), ("a", 3, 8), ("b", 4, 1), ("c", 5, 2)], "url string, seq int, checksum bigint")
    snap = spark.createDataFrame([("a", 7), ("b", 0)], "url string, checksum bigint")
    assert [r.changed for r in manifest.mark_changed(f, ["seq"], snap).orderBy("seq").collect()] == [False, False, True, True, True]
    assert rows(manifest.latest(f, ["url"], ["seq"])) == [("a", 3, 8), ("b", 4, 1), ("c", 5, 2)]
    plan = manifest.refresh_plan(spark.createDataFrame([("n", 1), ("s", 2), ("c", 3)], "url string, checksum bigint"), spark.createDataFrame([("s", 2), ("c", 4), ("d", 5)], "url string, checksum bigint"))
    assert rows(plan) == [("c", 3, 4, "changed", "embed"), ("d", 5, 5, "deleted", "delete"), ("n", 1, None, "new", "embed")]
    store = spark.createDataFrame([("c", 0, "old"), ("c", 1, "stale"), ("s", 0, "same")], "url string, chunk_id bigint, text string")
    new = spark.createDataFrame([("c", 0, "a"), ("c", 0, "b"), ("n", 0, "n")], "url string, chunk_id bigint, text string")
    keys = ["url", "chunk_id"]
    assert rows(manifest.upsert(store, new, keys, F.col("text"))) == [("c", 0, "b"), ("c", 1, "stale"), ("n", 0, "n"), ("s", 0, "same")]
    with pytest.raises(ValueError):
        manifest.insert_only(store, new, keys)
    assert rows(manifest.apply_plan(store, plan, new.where("text <> 'a'"))) == [("c", 0, "b"), ("n", 0, "n"), ("s", 0, "same")]
    assert manifest.ledger(plan, 5).first().emitted_at_epoch_ms == 5


def sequential_budget(costs, budget):
    kept, used = [], 0
    for i, c in enumerate(costs):
        if budget <= 0 or (kept and used + c > budget):
            break
        kept.append(i + 1)
        used += c
        if used >= budget:
            break
    return kept


def test_budget(spark):
    rng = random.Random(3)
    cases = [([rng.randrange(0, 9) for _ in range(6)], rng.randrange(0, 20)) for _ in range(60)]
    df = spark.createDataFrame([(q, i + 1, c, b) for q, (cs, b) in enumerate(cases) for i, c in enumerate(cs)], "query_id int, fused_rank int, token_estimate int, b int")
    got = {}
    for r in retrieval.within_budget(df, F.col("b")).collect():
        got.setdefault(r.query_id, []).append(r.fused_rank)
    assert all(sorted(got.get(q, [])) == sequential_budget(*c) for q, c in enumerate(cases))


def test_retrieval_edges(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (None, [1.0, 0.0]), (5, [0.0, 2.0])], "id bigint, embedding array<float>")
    assert rows(retrieval.dense_topk(v.withColumnRenamed("id", "query_id"), v)) == [(1, 1, 0.0, 1), (1, 5, 1.0, 2), (4, 4, 0.0, 1), (5, 1, 1.0, 2), (5, 5, 0.0, 1)]
    q = spark.createDataFrame([(1, "Red FOX"), (2, "the"), (3, None), (4, "")], "query_id bigint, query string")
    d = spark.createDataFrame([(10, "a red fox; red"), (11, "foxes, red"), (12, None), (13, "fox")], "id bigint, text string")
    for limit in (1 << 20, 0):
        assert rows(retrieval.lexical_simple(q, d, max_broadcast_bytes=limit)) == [(1, 10, 0.75, 1)]
    assert {(r.query_id, r.id) for r in retrieval.lexical_english(q, retrieval.postings(d)).collect()} == {(1, 10), (1, 11)}
    twice = d.union(spark.createDataFrame([(10, "a red fox; red"), (11, "nothing of it"), (10, "red red fox fox")], d.schema))
    for x in (d, twice):
        scans = [rows(retrieval.lexical_english_scan(q, x.distinct(), max_broadcast_bytes=limit)) for limit in (1 << 20, 0)]
        assert scans[0] == scans[1] == rows(retrieval.lexical_english(q, retrieval.postings(x))) and scans[0]
    assert rows(retrieval.lexical_simple(q, twice)) == rows(retrieval.lexical_simple(q, twice, max_broadcast_bytes=0))
    bad = spark.createDataFrame([(6, [float("inf"), 1.0]), (7, [float("nan"), 1.0])], "id bigint, embedding array<float>")
    assert rows(retrieval.dense_topk(v.withColumnRenamed("id", "query_id"), v.union(bad), block_bytes=1)) == rows(retrieval.dense_topk(v.withColumnRenamed("id", "query_id"), v))
    fused = retrieval.fuse(spark.createDataFrame([(1, 13, 0.1, 1), (1, 12, 0.2, 2)], "query_id bigint, id bigint, distance double, rank bigint"), retrieval.lexical_simple(q, d))
    final = retrieval.finalize(retrieval.keyword_fallback(fused, q, d)).orderBy("fused_rank").collect()
    # 13: 1/61 (dense) + 1/61 + 0.05 * 0.5 (fallback); 10: 1/61 + 0.05 * 0.75; 12: 1/62
    assert [(r.id, r.lexical_score, round(r.fused, 6)) for r in final] == [(13, 0.5, 0.057787), (10, 0.75, 0.053893), (12, None, 0.016129)]


def test_dense_search_in_blocks(spark, monkeypatch):
    """Against a plain product, with ties and vectors of two lengths; small tables are spread over many cells, none of which makes all distances at once."""
    rng = np.random.default_rng(6)
    v = {i: rng.integers(-2, 3, 4 if i % 10 else 6).astype(float) + 0.5 for i in range(1500)}
    df = spark.createDataFrame([(i, x.tolist()) for i, x in v.items()], "id bigint, embedding array<float>")
    monkeypatch.setattr(retrieval, "_FAR_CELLS", 1000)
    found = retrieval.dense_topk(df.withColumnRenamed("id", "query_id"), df, 5)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.distance))
    for q, x in list(v.items())[::37]:
        far = sorted((round(1 - float(x / np.sqrt(x @ x) @ (y / np.sqrt(y @ y))), 6) + 0.0, i) for i, y in v.items() if len(y) == len(x))[:5]
        assert sorted(got[q]) == [(k, i, d) for k, (d, i) in enumerate(far, 1)]
    assert len(got) == len(v) and "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()


def test_evaluation(spark):
    cases = spark.createDataFrame([(1, ["http://A", "http://b", "http://b"]), (2, []), (3, ["x"]), (4, None)], "query_id int, relevant array<string>")
    hits = spark.createDataFrame([(1, "http://z", 1), (1, "HTTP://a", 2), (1, "http://a", 3), (2, "q", 1)], "query_id int, url string, rank int")
    per = retrieval.evaluate_cases(cases, hits)
    assert rows(per) == [(1, 2, 1, 0.333333), (2, None, 0, None), (3, None, 0, 0.0), (4, None, 0, None)]
    assert tuple(retrieval.evaluate_summary(per).first()) == (4, 0.5, 0.25, 0.166667)


def test_evaluation_by_groups(spark):
    """The same as with lists of relevants, and no plan that makes them."""
    rng = random.Random(5)
    group = {i: None if i % 11 == 0 else i % 4 for i in range(1, 41)} | {99: 9}
    m = spark.createDataFrame(list(group.items()), "id bigint, group int")
    hits = spark.createDataFrame([(q, i, r) for q in group if q != 40 for r, i in enumerate(rng.sample(sorted(group), 6), 1)], "query_id bigint, id bigint, rank bigint")
    cases = spark.createDataFrame([(q, [str(i) for i in group if g is not None and group[i] == g and i != q]) for q, g in group.items()], "query_id bigint, relevant array<string>")
    per = {r.query_id: tuple(r)[1:] for r in retrieval.evaluate_groups(m, hits).collect()}
    want = {r.query_id: tuple(r)[1:] for r in retrieval.evaluate_cases(cases, hits.select("query_id", F.col("id").cast("string").alias("url"), "rank")).collect()}
    assert {q: x for q, x in per.items() if group[q] is not None} == {q: x for q, x in want.items() if group[q] is not None}
    assert {per[q] for q, g in group.items() if g is None} == {(None, 0, 0.0)} and per[99] == (None, 0, None)
    for name in ("eval_cases", "eval_summary"):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and "array_remove" not in plan


def test_samples(spark):
    rec = spark.createDataFrame([(1, "t", "b", [("c1", 3)], ("u",)), (2, None, None, None, None)], "ordinal int, text string, body_text string, chunks array<struct<text:string,chunk_id:bigint>>, metadata struct<url:string>")
    assert [(r.text, r.chunk_id, r.source_url) for r in dataset.iter_texts(rec).orderBy("pos").collect()] == [("t", None, "u"), ("b", None, "u"), ("c1", 3, "u")]
    j = dataset.judge_samples(spark.createDataFrame([(i, t) for i, t in enumerate(["aaaa key", "x", None, "bbbb", "cccc key", "v t e wikidata portal aaaa"])], "ordinal int, text string"), 3, 30, navbox_filter=True)
    assert [r.rejected for r in j.orderBy("ordinal").collect()] == [None, "below min_chars", "below min_chars", None, None, "navigation"]
    assert sorted(r.ordinal for r in dataset.first_accepted(j, 2).collect()) == [0, 1, 2, 3] and dataset.first_accepted(j, 9).count() == 6
    assert rows(dataset.keyword_coverage(j, ["KEY ", "wikidata", "none"])) == [("key", True, None), ("none", False, None), ("wikidata", False, "navigation")]
    for n, ratio, train, ev in ((50, 0.1, 45, 5), (3, 0.02, 2, 1), (1, 0.5, 1, 1), (4, 0.0, 4, 0)):
        s = dataset.train_eval_split(spark.range(n).withColumnRenamed("id", "doc_id"), ratio)
        assert (s.where("split = 'train'").count(), s.where("split = 'eval'").count()) == (train, ev)
    q = spark.createDataFrame([(1, "blue whale song"), (2, "the")], "query_id bigint, query string")
    d = spark.createDataFrame([(1, "whale WHALE blue"), (2, "song"), (3, None)], "id bigint, text string")
    for limit in (1 << 20, 0):
        assert rows(dataset.keyword_retrieve(q, d, max_broadcast_bytes=limit)) == [(1, 1, 0.666667, 1), (1, 2, 0.333333, 2)]
    assert [r.text for r in dataset.qa_pairs(q, d).collect()] == ["Question: blue whale song\nAnswer: whale WHALE blue"]
    assert dataset.perplexity(spark.createDataFrame([(-1.0,), (-3.0,)], "p double"), F.col("p")).first()[0] == pytest.approx(7.389056)


def test_text_columns(spark):
    t = spark.createDataFrame([("a  b\n",), ("é" * 150,)], "t string")
    assert [r[0] for r in t.select(TX.squeeze(F.col("t"))).collect()] == ["a b", "é" * 150]
    assert [r[0] for r in t.select(TX.token_estimate(F.col("t"))).collect()] == [2, 1]
    assert t.select(TX.snippet(F.col("t"))).collect()[1][0] == "é" * 150 + "…"
    assert [r[0] for r in spark.createDataFrame([(["A", " ", "B"],), ([],)], "p array<string>").select(TX.section_path(F.col("p"))).collect()] == ["A > B", None]


def test_answers_and_reports(spark, tmp_path):
    q = spark.createDataFrame([(1, "a", None, 10), (2, "b", 99, None), (3, "a", 0, None)], "query_id bigint, query string, top_k int, max_tokens bigint")
    checked = retrieval.checked_queries(q)
    assert [r.top_k for r in checked.orderBy("query_id").collect()] == [5, 12, 1]
    with pytest.raises(ValueError, match="empty query"):
        retrieval.checked_queries(q.withColumn("query", F.when(F.col("query_id") == 2, "  ").otherwise("x")))
    final = spark.createDataFrame([(1, None), (1, 0.5), (2, None)], "query_id bigint, lexical_score double")
    assert rows(retrieval.respond(final, checked, F.lit(3)).drop("top_k", "max_tokens")) == [(1, 2, "dense+lexical_rrf", 3.0), (2, 1, "dense_only", 3.0), (3, 0, "dense_only", 3.0)]
    calls = []

    class Counted(embedding.HashingClient):
        def embed_batch(self, texts):
            return [(i, v) for i, v in reversed(list(enumerate(super().embed_batch(texts))))]

    got = {r.query_id: r.embedding for r in retrieval.embed_queries(q, make_client=Counted).collect()}
    want = embedding.HashingClient().embed_batch(["a", "b"])
    assert got == {1: want[0], 2: want[1], 3: want[0]} and not calls
    per = spark.createDataFrame([(1, 2, 1, 0.5, 4.0), (2, None, 0, None, 8.0)], "query_id int, best_rank int, matched int, recall double, ms double")
    report = retrieval.write_report(per, str(tmp_path / "report"), F.col("ms"))
    assert report["summary"] == {"cases": 2, "hit_rate": 1.0, "mrr": 0.5, "mean_recall": 0.5, "avg_latency_ms": 6.0}
    (written,) = (tmp_path / "report").glob("*.txt")
    assert json.loads(written.read_text())["cases"][1]["query_id"] == 2


def test_embedding_order():
    class Odd(embedding.HashingClient):
        def embed_batch(self, texts):
            return [(1, [1.0]), (1, [2.0])]

    with pytest.raises(ValueError, match="indices"):
        embedding.call(Odd(), ["a", "b"])


def test_crawl_over_pages(spark):
    web = [("http://a/", 200, '<a href="/1"/><a href="/2"/><a href="/1"/><a href="http://z/"/>'), ("http://a/1", 200, '<a href="/3"/><a href="/"/>'), ("http://a/2", 404, '<a href="/9"/>'), ("http://a/3", 299, '<a href="/4"/>'), ("http://z/", 200, ""), ("http://a/4", 200, "x")]
    pages_ = spark.createDataFrame(web, "url string, status int, html string")
    seeds = spark.createDataFrame([("http://a/",), ("http://a/",), (None,)], "url string")
    done = crawl.crawl(seeds, pages_, 2, politeness_ms=9)
    assert rows(done.tasks) == [("http://a/", 0, 9, True), ("http://a/1", 1, 9, True), ("http://a/2", 1, 9, False), ("http://a/3", 2, 9, True), ("http://z/", 1, 9, True)]
    got = crawl.crawl_report(done, pages_, 4, 32, 2.0).first()
    assert (got.fetched, got.discovered, got.enqueued, got.duplicates, got.http_errors, got.parse_errors, got.normalised, got.rate_window, got.rate_wall) == (4, 6, 4, 2, 1, 1, 3, 2.0, None)
    assert got.local + got.remote == 6
    only = crawl.crawl(seeds, pages_, 9, ["a"], lambda u: ~u.endswith("/2"), 1)
    assert [r.url for r in only.tasks.orderBy("depth").collect()] == ["http://a/", "http://a/1", "http://a/3", "http://a/4"]
    assert crawl.crawl(seeds.limit(0), pages_).tasks.count() == 0 and rows(crawl.crawl(seeds, pages_, 0).tasks) == [("http://a/", 0, 250, True)]
    beats = spark.createDataFrame([(0,), (9_999,), (10_000,), (35_000,), (None,)], "t bigint")
    assert rows(crawl.heartbeat(beats, F.col("t"))) == [(0, 2, 2), (1, 1, 3), (3, 1, 4)]


def test_url_join_equals_the_library(spark):
    from urllib.parse import urljoin

    bases = ["http://a.b/c/d?q#f", "https://a.b", "http://u:p@a.b:8/x/y/z/", "http://a.b/?q", "nothing", None]
    hrefs = ["", "e", "./e", "../e", "../../../e", "/e/./f/../g", "?x=1", "#y", "//h/i", "mailto:x", "http://o/p", "e/../", ".", "..", "e?x=/../y", "g/h#i/../j", None]
    got = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string").select("b", "h", U.join_url(F.col("b"), F.col("h")).alias("j")).collect()
    for r in got:
        want = None if r.b is None or r.h is None else r.h if r.h.startswith(("mailto:", "http://o")) else None if r.b == "nothing" else urljoin(r.b if r.b != "https://a.b" else "https://a.b/", r.h)
        if r.h == "" and r.b and "#" in r.b:
            want = r.b.split("#")[0]
        assert r.j == want, (r.b, r.h, r.j, want)
    assert spark.createDataFrame([(" http://a/b c\\d\n\"<>",)], "u string").select(U.repair_url(F.col("u"))).first()[0] == "http://a/b%20c/d%22%3C%3E"


def test_headers_times_checksums(spark):
    h = spark.createDataFrame([({"Content-Type": " a "},), ({"x": "y"},), ({"content-TYPE": " "},), (None,)], "h map<string,string>")
    assert [r[0] for r in h.select(TX.header(F.col("h"), "content-type")).collect()] == ["a", None, None, None]
    assert spark.sql("select timestamp_ntz'1969-12-31 23:59:59.5' as t").select(TX.epoch_ms(F.col("t"))).first()[0] == -500
    import zlib

    assert spark.createDataFrame([("é",)], "t string").select(TX.crc32(F.col("t"))).first()[0] == zlib.crc32("é".encode())


def test_snapshots_and_dry_runs(spark, tmp_path):
    had = spark.createDataFrame([("a", 1, 5), ("b", 2, 5)], "url string, checksum bigint, last_seen_epoch_ms bigint")
    now = spark.createDataFrame([("a", 1, 7), ("c", 3, 7), ("c", 3, 8)], had.schema)
    manifest.write_snapshot(now, str(tmp_path / "s"), ["last_seen_epoch_ms"], had, carry_forward=True)
    assert rows(spark.read.json(str(tmp_path / "s")).select("url", "last_seen_epoch_ms", "changed")) == [("a", 7, False), ("b", 5, False), ("c", 7, True), ("c", 8, False)]
    with pytest.raises(Exception, match="(?i)exist"):
        manifest.write_snapshot(now, str(tmp_path / "s"), ["last_seen_epoch_ms"])
    plan = manifest.refresh_plan(now.where("last_seen_epoch_ms = 7").select("url", "checksum"), had.select("url", "checksum"))
    assert rows(manifest.execute_plan(had.select("url"), plan, now.select("url"), dry_run=True)) == [("delete", 1, 1, 0), ("embed", 1, 0, 2)]
    assert tuple(manifest.plan_totals(now.where("last_seen_epoch_ms = 7"), had, plan).first()) == (2, 2, 1, 0, 1, 1)
    with pytest.raises(ValueError, match="not a key"):
        sinks.chunk_table(now.select("url", F.lit(0).alias("chunk_id"), F.lit("x").alias("text")))
    two = sinks.chunk_table(spark.createDataFrame([("u", 0, "B a b"), ("u", 1, None)], "url string, chunk_id int, text string")).orderBy("chunk_id").collect()
    assert [(x.lexeme, x.positions) for x in two[0].lexemes] == [("a", [2]), ("b", [1, 3])] and two[1].lexemes == []
    big = tmp_path / "big.jsonl"
    big.write_text("".join(f'{{"url":"u{i % 7}","checksum":{i},"changed":true}}\n' for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert jsonl.read_numbered(spark, str(big), jsonl.MANIFEST).rdd.getNumPartitions() > 3
        assert {r.url: r.checksum for r in jsonl.read_manifest(spark, str(big)).collect()} == {f"u{i % 7}": i for i in range(4993, 5000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_training_prompts(spark):
    q = spark.createDataFrame([(1, " why? "), (2, "x")], "query_id bigint, query string")
    h = spark.createDataFrame([(1, 2, "b "), (1, 1, "a")], "query_id bigint, rank bigint, text string")
    assert rows(dataset.training_prompts(h, q)) == [(1, "Document 1:\na\n\nDocument 2:\nb\n\nQuestion: why?\nAnswer:"), (2, "Question: x\nAnswer:")]


def test_embed(spark):
    df = spark.createDataFrame([(1, "x y"), (2, None)], "k int, text string")
    got = {r.k: r.embedding for r in embedding.embed(df, batch_size=1).collect()}
    assert len(got[1]) == 64 and got[2] is None


def test_sources_and_sinks(spark, tmp_path):
    f = tmp_path / "m.jsonl"
    f.write_text('{"url":"a","checksum":1,"changed":true}\n\n{"url":"b","checksum":2,"changed":true}\n{"url":"a","checksum":4294967295,"changed":false}\n')
    assert rows(jsonl.read_manifest(spark, str(f)).select("url", "checksum", "changed")) == [("a", 4294967295, False), ("b", 2, True)]
    assert jsonl.read_manifest(spark, str(tmp_path / "none"), missing_ok=True).count() == 0
    (tmp_path / "bad.jsonl").write_text('{"url":"a"}\n{broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), jsonl.MANIFEST).collect()
    (tmp_path / "q.txt").write_text('{"question":"A?"}\n{"prompt":"B?"}\n  plain \n\n')
    assert sorted(r.query for r in jsonl.read_questions(spark, str(tmp_path / "q.txt")).collect()) == ["A?", "B?", "plain"]
    (tmp_path / "t.jsonl").write_text('{"text":"one"}\n{"text":" "}\n{}\n')
    assert rows(jsonl.read_texts(spark, str(tmp_path / "t.jsonl"), str(tmp_path / "missing.txt"))) == [("one",)]
    df = spark.createDataFrame([("http://a/", "é", None), ("http://b/", "x", 3)], "url string, text string, shard int")
    sinks.write_jsonl(df, str(tmp_path / "out"))
    lines = [json.loads(x) for p in (tmp_path / "out").glob("*.json") for x in p.read_text().splitlines()]
    assert {"url": "http://a/", "text": "é", "shard": None} in lines
    sinks.append_ledger(df.limit(0), str(tmp_path / "ledger"))
    assert not (tmp_path / "ledger").exists()
    sinks.write_striped(df, str(tmp_path / "striped"), 3, shard_col="shard")
    assert spark.read.json(str(tmp_path / "striped")).count() == 2
    (tmp_path / "p.html").write_text("<p>x</p>")
    assert jsonl.read_html(spark, str(tmp_path / "p.html")).count() == 1


def test_html_files(spark, tmp_path):
    """As binaryFile reads them, in tasks: a read has no list of files in its plan, and a write no folder for each file."""
    path = str(tmp_path / "html")
    p = spark.createDataFrame([(i, f"<p>é {i}\n</p>".encode() if i % 7 else None) for i in range(300)], "page_id bigint, html binary")
    sinks.write_html(p.repartition(3), path, "page_id", folders=5)
    sinks.write_html(p.where("page_id < 9"), path, "page_id", folders=5)  # as a task that is tried again
    (tmp_path / "html" / "0" / ".hidden.html").write_text("x")
    (tmp_path / "html" / "0" / "other.txt").write_text("x")
    assert len(list((tmp_path / "html").iterdir())) == 5
    got = jsonl.read_html(spark, f"{path}/*/*.html")
    plain = spark.read.format("binaryFile").load(f"{path}/*/*.html").select("path", "content")
    assert rows(got.where("octet_length(html) > 0")) == rows(plain) and got.count() == 300  # binaryFile passes over empty files
    assert "binaryFile" not in got._jdf.queryExecution().executedPlan().toString()
    assert jsonl.read_html(spark, f"{path}/*/*.none").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(4)
    all_rows = [(f"u{rng.randrange(5)}", i, str(rng.randrange(2))) for i in range(60)]
    schema = "url string, seq bigint, checksum string"
    for k in range(3):  # three files, a micro-batch each
        spark.createDataFrame(all_rows[20 * k : 20 * k + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = stateful.run_available(stateful.mark_changed_stream(stream))
    assert rows(got) == rows(manifest.mark_changed(spark.createDataFrame(all_rows, schema), ["seq"]))
    assert stateful.run_available(stateful.dedupe_urls_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))).count() == 5


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_marks_of_a_stream_by_buckets(spark, tmp_path, buckets):
    """Many URLs are one group, and its state goes on over micro-batches; null checksums count as changed, as does what follows them."""
    rng = random.Random(8)
    m = [(f"u{rng.randrange(30)}", i, rng.choice(["a", "b", None])) for i in range(240)] + [(None, 999, "a")]
    schema = "url string, seq bigint, checksum string"
    for k in range(0, len(m), 80):
        spark.createDataFrame(m[k : k + 80], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    last, want = {}, []
    for u, i, c in m[:240]:
        want.append((u, i, c, last.get(u) is None or c != last[u]))
        last[u] = c
    assert rows(stateful.run_available(stateful.mark_changed_stream(stream, buckets))) == sorted(want, key=repr)


def test_rate_limit_stream_goes_on_over_batches(spark, tmp_path):
    m = [("a", t, i) for i, t in enumerate((0, 0, 0, 1000, 1500, 60000))] + [("b", 0, 9)]
    schema = "client string, ts_ms bigint, request bigint"
    for k in range(0, len(m), 2):
        spark.createDataFrame(m[k : k + 2], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = stateful.run_available(stateful.rate_limit_stream(stream, 60, 2))
    assert {r.request: r.allowed for r in got.collect()} == {0: True, 1: True, 2: False, 3: True, 4: False, 5: True, 9: True}


def test_rate_limit(spark):
    m = [("a", t) for t in (0, 0, 0, 1000, 1500, 60000)] + [("b", 0)]
    got = stateful.rate_limit(spark.createDataFrame(m, "client string, ts_ms bigint"), 60, 2)
    assert [r.allowed for r in got.where("client = 'a'").orderBy("ts_ms", F.desc("allowed")).collect()] == [True, True, False, True, False, True]
