import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.providers import HashingEmbedder, KeywordClassifier, RateLimited, RuleExtractor, embed, extract, quick_filter, retried, same_model, translated
from tidemark.operators import filters, tables, vectors
from tidemark.plans.funnel import Config, run, stage_bucket, write
from tidemark.sources import feeds, sheets, stages
from tidemark.streaming import queue

ART = "article_id bigint, url string, title string, content string, published_date string, source string, embedding_status string, embedded_at string, error_message string"


def articles(spark):
    return spark.createDataFrame(
        [
            (1, "https://a.org/1", "Alpha to buy Beta", "Alpha will buy Beta for oncology. " * 20, "2022-01-05", "A", "pending", None, None),
            (2, "https://a.org/2", "Alpha to buy Beta now", "Alpha will buy Beta for oncology. " * 25, "2022-01-06", "A", "pending", None, None),
            (3, "https://a.org/3", "Gamma licenses Delta", "Gamma licenses Delta, an oncology drug. " * 20, "2022-02-01", "B", "pending", None, None),
            (4, "https://a.org/financings-roundup", "Roundup", "x", "2022-02-01", "B", "pending", None, None),
            (5, None, None, None, None, None, "pending", None, None),
        ],
        ART,
    )


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", "1", "embedded"), ("b", "2", "failed")], "k string, v string, s string")
    new = spark.createDataFrame([("b", "3", 1), ("b", "4", 2), ("c", "5", 1)], "k string, v string, n int").withColumn("s", F.lit("x"))
    once = tables.upsert(old, new, "k", "n", {"s": F.lit("pending")})
    want = {("a", "1", "embedded"), ("b", "4", "pending"), ("c", "5", "pending")}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in tables.upsert(once, new, "k", "n", {"s": F.lit("pending")}).collect()} == want
    assert {tuple(r) for r in tables.insert_new(old, new, "k", "n").collect()} == {("a", "1", "embedded"), ("b", "2", "failed"), ("c", "5", "x")}


def test_batches_and_rates(spark):
    rows = spark.range(1000).select(F.col("id").alias("article_id"))
    got = {r.article_id: r.batch for r in tables.batches(rows, 40, "article_id").collect()}
    assert got == {i: i // 40 for i in range(1000)}
    ts = [(1, t) for t in (0, 0, 59, 60, 119, 2000)] + [(2, 5)]
    ev = spark.createDataFrame(ts, "u int, s int").select("u", F.timestamp_seconds("s").alias("ts"))
    seen = {(r.u, r.t): r.in_window for r in tables.sliding_count(ev, "u", "ts", 60).collect()}
    assert seen == {(1, 0): 2, (1, 59): 3, (1, 60): 2, (1, 119): 2, (1, 2000): 1, (2, 5): 1}


def test_site_rules(spark):
    rows = spark.createDataFrame([("A", "https://x/news/1"), ("A", "https://x/tag/1"), ("B", "https://y/tag/1"), (None, "https://z"), ("A", None)], "source string, url string")
    rules = spark.createDataFrame([("A", "allow", "/news/"), ("A", "block", "/tag/")], "site string, kind string, pattern string")
    assert {tuple(r) for r in filters.site_allows(rows, rules).collect()} == {("A", "https://x/news/1"), ("B", "https://y/tag/1"), (None, "https://z")}


def test_url_patterns(spark):
    urls = ["https://a/financings/", "https://a/financings-roundup", "https://a/earnings", "https://a/TOP-10-DEALS", "https://a/earnings/q1", "https://a/ok", None]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in rows.select(filters.rejected_url()).collect()] == [True, True, True, True, False, False, False]


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 8)).astype(np.float32)
    m[7] = m[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(999, None)], "vec_id bigint, embedding array<float>").repartition(5)
    got = {(r.query_id, r["rank"]): r.id for r in vectors.neighbours(df.where("vec_id < 20"), df, 5).collect()}
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    for q in range(20):
        s = np.round(u @ u[q], 6)
        want = sorted(range(300), key=lambda i: (-s[i], i))[:5]
        assert [got[q, k + 1] for k in range(5)] == want
    assert vectors.neighbours(df.limit(0), df, 5).count() == 0


def greedy_choice(order: list, near: dict, length: dict) -> list:
    """The definition: the rows that stay, in the order they are told: in input order, an unseen row and its neighbours, seen or not,
    give their longest (the first of several); all others count as seen; a longest seen before is not told again."""
    seen: set = set()
    out = []
    for i in order:
        if i in seen:
            continue
        group = [i, *near.get(i, [])]
        best = group[0]
        for j in group[1:]:
            if length[j] > length[best]:
                best = j
        seen.update(j for j in group if j != best)
        if best not in seen:
            out.append(best)
            seen.add(best)
    return out


def test_greedy_choice():
    length = {1: 5, 2: 9, 3: 7, 4: 1}
    assert greedy_choice([1, 2, 3, 4], {1: [2], 2: [1, 3], 3: [2]}, length) == [2, 4]
    assert greedy_choice([1], {}, length) == [1] and greedy_choice([], {}, {}) == []
    assert greedy_choice([1, 4], {1: [4], 4: [1]}, {1: 3, 4: 3}) == [1]


def test_greedy_against_definition(spark):
    """Random neighbours of 400 rows, hot ones and a long chain among them, against the choice row by row."""
    rng = np.random.default_rng(11)
    n = 400
    length = [int(x) for x in rng.integers(0, 9, n)]
    ord_ = [float(x) for x in rng.integers(0, 300, n)]
    near = {i: [j for j in dict.fromkeys([int(x) for x in rng.integers(0, n, 4)] + ([7] if i % 3 == 0 else []) + ([i + 1] if i < 12 else [])) if j != i] for i in range(n) if i % 5}
    order = sorted(range(n), key=lambda i: (ord_[i], i))
    want = greedy_choice(order, near, dict(enumerate(length)))
    rows = spark.createDataFrame([(i, ord_[i], length[i]) for i in range(n)], "id bigint, ord double, length bigint")
    known = spark.createDataFrame([(i, j, 0.9, k + 1) for i, x in near.items() for k, j in enumerate(x)] + [(1, 2, 0.5, 9), (3, 3, 1.0, 0)], "query_id bigint, id bigint, similarity double, rank int")
    got = [r.id for r in vectors.greedy_distinct(rows, near=known).orderBy("pos").collect()]
    assert got == want
    assert vectors.greedy_distinct(rows.limit(0), near=known.limit(0)).count() == 0



def test_providers(spark, tmp_path):
    class Picky(HashingEmbedder):
        def encode(self, texts):
            if any("Roundup" in t for t in texts):
                raise ValueError("no roundups")
            return super().encode(texts)

    got = {r.article_id: r for r in embed(articles(spark).where("article_id < 5"), Picky()).collect()}
    assert len(got[1].embedding) == 64 and got[4].embedding is None and "no roundups" in got[4].error
    waits, calls = [], []

    def limited():
        calls.append(1)
        if len(calls) < 3:
            raise RateLimited
        return "ok"

    assert retried(limited, sleep=waits.append) == "ok" and waits == [5.0, 10.0]
    kept = quick_filter(articles(spark), KeywordClassifier(["oncology"])).collect()
    assert {r.article_id for r in kept} == {1, 2, 3}

    class Broken:
        def classify(self, titles, contents):
            raise ValueError

    assert quick_filter(articles(spark), Broken()).count() == 5
    assert {r.article_id: r.raw_json is None for r in extract(articles(spark), RuleExtractor()).collect()} == {1: False, 2: False, 3: False, 4: True, 5: True}
    a = embed(articles(spark).where("article_id = 1"), HashingEmbedder(8))
    try:
        same_model(a, embed(articles(spark).where("article_id = 1"), HashingEmbedder(16)))
        raise AssertionError
    except ValueError:
        pass
    texts = spark.createDataFrame([("hallo", "de"), ("hallo", "de"), ("hi", "en"), ("", "de"), (None, None)], "text string, lang string")
    path = str(tmp_path / "cache")
    first = translated(texts, path, lambda ts: [t.upper() for t in ts])
    assert sorted(r.translation or "" for r in first.collect()) == ["", "", "HALLO", "HALLO", "hi"]

    def never(ts):
        raise ValueError

    assert sorted(r.translation or "" for r in translated(texts, path, never).collect()) == ["", "", "HALLO", "HALLO", "hi"]


def test_queue(spark):
    snap, vecs = queue.process_pending(articles(spark), HashingEmbedder(), "2024-01-01T00:00:00Z")
    got = {r.article_id: (r.embedding_status, r.error_message) for r in snap.collect()}
    assert got[1] == ("embedded", None) and got[5] == ("failed", "Missing required fields") and vecs.count() == 4
    assert queue.retry_failed(snap).where("embedding_status = 'pending'").count() == 1


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    articles(spark).write.parquet(src)
    queue.stream_embeddings(spark, src, ART, out, str(tmp_path / "ck"), HashingEmbedder()).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    queue.stream_embeddings(spark, src, ART, out, str(tmp_path / "ck"), HashingEmbedder()).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    urls = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "url string")
    urls.write.parquet(str(tmp_path / "u"))
    queue.stream_new_urls(spark, str(tmp_path / "u"), "url string", str(tmp_path / "uo"), str(tmp_path / "uc")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "uo")).count() == 2
    spark.range(300).select(F.timestamp_seconds(F.col("id") * 10).alias("ts"), F.lit(1).alias("user_id")).write.parquet(str(tmp_path / "e"))
    queue.stream_rates(spark, str(tmp_path / "e"), "ts timestamp, user_id int", str(tmp_path / "eo"), str(tmp_path / "ec"), "1 minute").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "eo")).agg(F.max("n")).first()[0] == 6


def test_feeds(spark, tmp_path):
    (tmp_path / "rss.xml").write_text("<rss><channel><item><title> T1 </title><link>https://a/1</link><pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate></item><item><title>T2</title><link>https://a/2</link></item><item><title>old</title><link>https://a/3</link><pubDate>Tue, 05 Mar 2019 10:00:00 +0000</pubDate></item><item><title>no link</title></item></channel></rss>")
    got = {r.url: (r.title, r.published_date) for r in feeds.feed(spark, str(tmp_path / "rss.xml"), "2024-01-01").collect()}
    assert got == {"https://a/1": ("T1", "2024-03-05"), "https://a/2": ("T2", None)}
    (tmp_path / "atom.xml").write_text('<feed><entry><title>A</title><link href="https://b/1"/><updated>2024-03-05T10:00:00Z</updated></entry></feed>')
    assert [tuple(r) for r in feeds.feed(spark, str(tmp_path / "atom.xml")).collect()] == [("https://b/1", "A", "2024-03-05", "Atom")]
    (tmp_path / "map.xml").write_text("<urlset><url><loc>https://c/1</loc><lastmod>2024-02-03</lastmod></url><url><loc>https://c/2</loc></url><url><loc>https://c/3</loc><lastmod>2001-02-03T01:00:00</lastmod></url></urlset>")
    assert {r.url for r in feeds.sitemap(spark, [str(tmp_path / "map.xml")], "2024-01-01").collect()} == {"https://c/1", "https://c/2"}
    (tmp_path / "index.xml").write_text("<sitemapindex><sitemap><loc>https://c/sitemap-2019.xml</loc></sitemap><sitemap><loc>https://c/sitemap-2022.xml</loc></sitemap><sitemap><loc>https://c/sitemap-topics.xml</loc></sitemap></sitemapindex>")
    assert feeds.sitemaps_of(spark, str(tmp_path / "index.xml"), 2021) == ["https://c/sitemap-2022.xml"]
    pages = spark.createDataFrame([('<a href="/x">1</a><a href="https://d/y">2</a><a href="/x">3</a>', "2024-01-01")], "html string, published_date string")
    assert {r.url for r in feeds.links(pages, "https://d").collect()} == {"https://d/x", "https://d/y"}


def test_stages(spark, tmp_path):
    root, made = str(tmp_path), []

    def make():
        made.append(1)
        return spark.range(3)

    assert stages.resumed(spark, root, {"q": 1}, "s", make).count() == 3 == stages.resumed(spark, root, {"q": 1}, "s", make).count()
    stages.resumed(spark, root, {"q": 2}, "s", make)
    assert len(made) == 2
    stages.clear_stages(spark, root, {"q": 1})
    assert stages.read_stage(spark, root, {"q": 1}, "s") is None and stages.read_stage(spark, root, {"q": 2}, "s") is not None
    stages.write_checkpoint(spark.range(2), str(tmp_path / "c"))
    assert stages.read_checkpoint(spark, str(tmp_path / "c")).count() == 2 and stages.read_checkpoint(spark, str(tmp_path / "none")) is None
    stages.ensure_table(spark, str(tmp_path / "t"), "url string, source string, published_date string, crawled_at string")
    assert stages.url_index(spark, str(tmp_path / "t")).count() == 0
    assert stages.listing(spark, str(tmp_path / "t"), "*.parquet").count() >= 0


def test_funnel_end_to_end(spark, tmp_path):
    arts = articles(spark)
    config = Config("oncology", "2021-01-01", "2023-01-01", least_similarity=0.0, keywords=("oncology",))
    stored = embed(arts.where("article_id < 5"), HashingEmbedder())
    rows = run(arts, stored, config, str(tmp_path / "stages")).collect()
    assert {r.acquirer for r in rows} == {"Alpha", "Gamma"} and len(rows) == 2
    assert {r.reject_reason for r in rows} == {"model_error"}
    df = spark.createDataFrame([("Phase 1",), ("phase III",), ("clinical",), ("phase 4",), ("",), (None,)], "stage string")
    assert [r[0] for r in df.select(stage_bucket()).collect()] == ["EARLY_STAGE", "MID_STAGE", "UNDISCLOSED", None, None, None]
    good = run(arts, stored, config, str(tmp_path / "stages")).withColumn("reject_reason", F.lit(None).cast("string")).withColumn("day", F.lit("2022-01-01").cast("date"))
    write(good, str(tmp_path / "sheets"), "onc area")
    (path,) = (tmp_path / "sheets").glob("*.xlsx")
    assert path.name.startswith("deals_onc_area_UNDISCLOSED_2")
    config.save(str(tmp_path / "config"))
    assert Config.load(str(tmp_path / "config")) == config


def test_workbook_opens(spark, sf, tmp_path):
    import zipfile

    deals = spark.read.parquet(f"{sf}/deals.parquet")
    (path,) = sheets.write_sheets(deals, str(tmp_path / "w"))
    with zipfile.ZipFile(path) as z:
        assert z.read("xl/worksheets/sheet1.xml").count(b"<row ") == deals.count() + 1
    lines = [r.value for r in sheets.evidence_lines(deals).collect()]
    import json

    assert len(lines) == deals.count() and len(json.loads(lines[0])) == 12


def test_pages(spark):
    from tidemark.sources.pages import StoredPages, articles_of, fetched

    urls = spark.createDataFrame([("https://a/1", "t", "2024-01-01", "RSS"), ("https://a/2", "t", None, "RSS"), ("https://b/3", "t", "2020-01-01", "RSS"), ("https://b/4", "t", "2024-01-01", "RSS")], "url string, title string, published_date string, source string")
    pages = fetched(urls, StoredPages({"https://a/1": "<p>" + "word " * 200 + "</p>", "https://a/2": "Cloudflare Ray ID: 1", "https://b/3": "<p>" + "x " * 400}))
    assert {r.url: r.html is None for r in pages.collect()} == {"https://a/1": False, "https://a/2": False, "https://b/3": False, "https://b/4": True}
    assert [r.url for r in articles_of(pages, "2022-01-01", "2024-12-31").collect()] == ["https://a/1"]


def test_command_line(spark, tmp_path):
    from tidemark.__main__ import main

    articles(spark).withColumns({"fetched_at": F.lit(""), "lastmod": F.lit("")}).write.parquet(str(tmp_path / "a"))
    main(["embed", "--articles", str(tmp_path / "a"), "--out", str(tmp_path / "b"), "--vectors", str(tmp_path / "v")], spark)
    assert spark.read.parquet(str(tmp_path / "b")).where("embedding_status = 'embedded'").count() == 4
    (tmp_path / "c.json").write_text('{"topic": "oncology", "start": "2021-01-01", "end": "2023-01-01", "least_similarity": 0.0}')
    main(["run", "--config", str(tmp_path / "c.json"), "--articles", str(tmp_path / "b"), "--vectors", str(tmp_path / "v"), "--stages", str(tmp_path / "s"), "--sheets", str(tmp_path / "x")], spark)
    spark.createDataFrame([("https://a.org/1", "t", "d", "RSS"), ("https://new", "t", "d", "RSS"), ("https://new", "", "d", "Sitemap")], "url string, title string, published_date string, source string").write.parquet(str(tmp_path / "d"))
    main(["update", "--articles", str(tmp_path / "b"), "--discovered", str(tmp_path / "d"), "--out", str(tmp_path / "n")], spark)
    assert spark.read.parquet(str(tmp_path / "n")).count() == 6
    spark.createDataFrame([("https://new", "<p>" + "word " * 200 + "</p>"), ("https://a.org/1", "<p>known</p>")], "url string, html string").write.parquet(str(tmp_path / "p"))
    main(["update", "--articles", str(tmp_path / "b"), "--discovered", str(tmp_path / "d"), "--out", str(tmp_path / "m"), "--pages", str(tmp_path / "p"), "--start", "2020-01-01"], spark)
    (new,) = spark.read.parquet(str(tmp_path / "m")).where("url = 'https://new'").collect()
    assert new.content.startswith("word word") and new.embedding_status == "pending"
    main(["embed", "--articles", str(tmp_path / "a"), "--out", str(tmp_path / "b2"), "--vectors", str(tmp_path / "v")], spark)
    vecs = spark.read.parquet(str(tmp_path / "v"))
    assert vecs.count() == vecs.select("article_id").distinct().count() == 4
    main(["reset", "--articles", str(tmp_path / "b"), "--out", str(tmp_path / "r"), "--vectors", str(tmp_path / "v"), "--yes"], spark)
    assert spark.read.parquet(str(tmp_path / "r")).where("embedding_status = 'pending'").count() == 5
    assert spark.read.parquet(str(tmp_path / "v")).count() == 0


def test_sitemap_indexes_in_indexes(spark, tmp_path):
    def index(name, *locs):
        (tmp_path / name).write_text("<sitemapindex>" + "".join(f"<sitemap><loc>{tmp_path / x}</loc></sitemap>" for x in locs) + "</sitemapindex>")

    index("top.xml", "b.xml", "a.xml", "top.xml")
    index("a.xml", "map1.xml", "b.xml")
    index("b.xml", "map2.xml")
    for k in (1, 2):
        (tmp_path / f"map{k}.xml").write_text(f"<urlset><url><loc>https://c/{k}</loc></url></urlset>")
    found = feeds.sitemaps_of(spark, str(tmp_path / "top.xml"))
    assert sorted(found) == [str(tmp_path / f"map{k}.xml") for k in (1, 2)]
    assert {r.url for r in feeds.sitemap(spark, found).collect()} == {"https://c/1", "https://c/2"}


def test_polite_fetcher():
    from tidemark.sources.pages import PoliteFetcher, Refused, StoredPages

    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    class Guarded(StoredPages):
        def fetch(self, url):
            if "guard" in url:
                raise Refused(url)
            return super().fetch(url)

    stored = Guarded({"https://a/robots.txt": "User-agent: *\nDisallow: /no\nCrawl-delay: 3", "https://a/1": "one", "https://a/no/2": "two", "https://a/c": "cloudflare Ray ID: 9"})
    f = PoliteFetcher(stored, 1.0, fallback=StoredPages({"https://a/guard": "seen", "https://a/c": "real"}), clock=lambda: now[0], sleep=sleep)
    assert [f.fetch(f"https://a/{x}") for x in ("1", "no/2", "guard", "c")] == ["one", None, "seen", "real"]
    assert slept == [3.0, 3.0, 3.0] and f.fetch("https://b/1") is None
    import pickle

    assert pickle.loads(pickle.dumps(PoliteFetcher(StoredPages({}), clock=now.copy, sleep=slept.append)))._last == {}


def test_parts_and_replaced_tables(spark, tmp_path):
    made = []

    def make(rows):
        made.append(1)
        if len(made) == 3:
            raise RuntimeError("stopped")
        return rows.withColumn("x", F.col("id") * 2)

    rows = spark.range(1000)
    with pytest.raises(RuntimeError):
        stages.resumed_in_parts(rows, str(tmp_path), {"q": 1}, "s", make, "id")
    out = stages.resumed_in_parts(rows, str(tmp_path), {"q": 1}, "s", make, "id")
    assert len(made) == 5 and out.count() == 1000 == out.select("x").distinct().count()
    path = str(tmp_path / "t")
    stages.replace_table(spark.range(3), path)
    stages.replace_table(spark.read.parquet(path).unionByName(spark.range(7, 9)), path)
    assert spark.read.parquet(path).count() == 5 and [x.name for x in tmp_path.iterdir() if ".new-" in x.name] == []


def test_vector_search_and_index(spark, tmp_path):
    """Search equals brute force, with nulls and zeros; the index finds nearly all and, with all clusters, all."""
    from tidemark.operators import vectors

    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label")
    odd = spark.createDataFrame([(900_001, None, 1), (900_002, [0.0] * 64, 1), (900_003, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")
    df = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("int").alias("label"))
    got = df.toPandas()
    m = vectors._unit(np.stack(got["embedding"].to_numpy()).astype(float))
    q = list(got["embedding"][3])
    sim = np.round(m @ (np.array(q) / np.linalg.norm(q)), 6)
    want = [int(got["vec_id"][i]) for i in np.lexsort((got["vec_id"], -sim)) if got["label"][i] != 3][:40]
    found = vectors.search(df.unionByName(odd).repartition(5), q, 40, keep=F.col("label") != 3, exact=True, carry=("label",)).collect()
    assert [r.vec_id for r in found] == want and found[0].label is not None
    assert vectors.search(df.limit(0), q, 5).count() == 0
    centres = vectors.write_index(df.unionByName(odd), str(tmp_path / "ix"), 16)
    ix = spark.read.parquet(str(tmp_path / "ix"))
    assert ix.count() == len(got) + (1 if m.shape[1] == 64 else 0)
    asked = df.where("vec_id % 5 = 0")
    exact = {(r.query_id, r.id) for r in vectors.neighbours(asked, df, 10).collect()}
    probes = vectors.probes_for(ix, centres)
    near = {(r.query_id, r.id) for r in vectors.near_neighbours(asked, ix, centres, 10, probes).collect()}
    assert probes < 16 and len(exact & near) >= 0.9 * len(exact)
    whole = {(r.query_id, r.id) for r in vectors.near_neighbours(asked, ix, centres, 10, 16).collect()}
    assert len(exact - whole) <= 0.01 * len(exact)  # equal but for vectors of zeros
    assert [r.vec_id for r in vectors.search_index(ix, centres, q, 10, 16).collect()] == [r.vec_id for r in vectors.search(df, q, 10, exact=True).collect()]


def test_stages_need_a_shared_folder(spark, monkeypatch):
    from tidemark import session

    class Far:
        master = "spark://far:7077"

    class Session:
        conf, sparkContext = {}, Far()

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Session())
    path = session.stage(spark.range(3), "x").inputFiles()[0]
    session.drop_stages(spark)
    assert not __import__("os").path.exists(path.removeprefix("file://"))
