"""Queries of the core's operators over whole tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import money, text
from tidemark.operators import extractions, filters, names, tables, vectors
from tidemark.plans import funnel
from tidemark.session import shared_dir, table
from tidemark.sources import feeds, sheets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: table(spark, sf_dir, name))

        run.__name__ = f.__name__
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Scans and queues


@query("SELECT article_id, url, fetched_at FROM articles WHERE embedding_status = 'pending' ORDER BY fetched_at NULLS FIRST, url, article_id LIMIT 500 OFFSET 40")
def scan_pending(t):
    return tables.pending(t("articles"), 500, 40).select("article_id", "url", "fetched_at")


@query("SELECT article_id, embedded_at, error_message FROM articles WHERE embedding_status = 'failed' ORDER BY embedded_at DESC NULLS LAST, article_id LIMIT 100")
def scan_failed(t):
    return tables.failed(t("articles")).select("article_id", "embedded_at", "error_message")


@query("SELECT vec_id, label::BIGINT AS label, len(embedding)::BIGINT AS dims FROM embeddings WHERE embedding IS NOT NULL")
def scan_vectors(t):
    return t("embeddings").where("embedding is not null").select("vec_id", F.col("label").cast("bigint").alias("label"), F.size("embedding").cast("bigint").alias("dims"))


# Filters


@query("SELECT article_id, published_date FROM articles WHERE length(coalesce(published_date, '')) >= 10 AND published_date BETWEEN '2020-01-01' AND '2023-06-30'")
def filter_dates(t):
    return t("articles").where(filters.valid_date() & filters.in_dates("2020-01-01", "2023-06-30")).select("article_id", "published_date")


_REJECT = "|".join(f"(?:{p})" for p in filters.URL_REJECTS)


@query(f"SELECT article_id, url FROM articles WHERE NOT regexp_matches(coalesce(url, ''), '(?i){_REJECT}')")
def filter_url_patterns(t):
    return t("articles").where(~filters.rejected_url()).select("article_id", "url")


@query("""
SELECT article_id, url, source FROM articles
WHERE source IS NULL OR (NOT regexp_matches(url, '^https?://[^/]+/(?:earnings|press)/') AND regexp_matches(url, '^https?://[^/]+/(?:news|deals|analysis|financings)/'))
""")
def filter_site_rules(t):
    sites = t("sites").select(F.col("source").alias("site"))
    rules = sites.select("site", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(p).alias("pattern")) for k, p in (("block", "^https?://[^/]+/(?:earnings|press)/"), ("allow", "^https?://[^/]+/(?:news|deals)/"), ("allow", "^https?://[^/]+/(?:analysis|financings)/"))))).alias("r")).select("site", "r.*")
    return filters.site_allows(t("articles"), rules).select("article_id", "url", "source")


@query("SELECT article_id, source FROM articles WHERE source IN (SELECT source FROM sites WHERE lang = 'de' OR date_order = 'mdy')")
def filter_sources(t):
    wanted = t("sites").where("lang = 'de' or date_order = 'mdy'").select("source")
    return t("articles").select("article_id", "source").join(wanted, "source", "left_semi")


@query("SELECT article_id, length(content)::BIGINT AS chars FROM articles WHERE length(trim(coalesce(content, ''))) >= 500")
def filter_long_content(t):
    return t("articles").where(filters.long_enough()).select("article_id", F.length("content").cast("bigint").alias("chars"))


@query("SELECT article_id FROM articles WHERE coalesce(published_date, '2025-12-31') >= '2022-01-01'")
def filter_fetched_since(t):
    return t("articles").where(filters.fetched_since("2022-01-01", "2025-12-31")).select("article_id")


@query("SELECT article_id, CASE WHEN coalesce(url, '') = '' OR coalesce(content, '') = '' THEN 'failed' ELSE embedding_status END AS status, CASE WHEN coalesce(url, '') = '' OR coalesce(content, '') = '' THEN 'Missing required fields' END AS problem FROM articles")
def route_required(t):
    rows = t("articles").withColumn("problem", filters.required("url", "content"))
    return rows.select("article_id", F.when(F.col("problem").isNotNull(), "failed").otherwise(F.col("embedding_status")).alias("status"), "problem")


_YEAR = r"coalesce(nullif(regexp_extract(u, '(?i)sitemap-(\d{4})', 1), ''), nullif(regexp_extract(u, '_(\d{4})\.xml', 1), ''))"


@query(f"WITH m AS (SELECT DISTINCT 'https://' || host || '/sitemap-' || y || '.xml' AS u FROM sites, unnest(['2018', '2019', '2021', 'topics', 'news_2020', 'archive_2024']) AS t(y)) SELECT u AS url FROM m WHERE NOT contains(u, 'sitemap-topics') AND ({_YEAR} IS NULL OR {_YEAR}::INT >= 2020)")
def filter_archive_years(t):
    names_ = F.explode(F.array(*map(F.lit, ("2018", "2019", "2021", "topics", "news_2020", "archive_2024"))))
    urls = t("sites").select("host", names_.alias("y")).select(F.concat(F.lit("https://"), "host", F.lit("/sitemap-"), "y", F.lit(".xml")).alias("url")).distinct()
    return filters.recent_archives(urls, 2020)


@query("SELECT article_id, url, coalesce(title, '') AS title, substring(coalesce(content, ''), 1, 1000) AS content, coalesce(source, 'Unknown') AS source FROM articles")
def reshape_articles(t):
    return t("articles").select("article_id", "url", F.coalesce("title", F.lit("")).alias("title"), F.substring(F.coalesce("content", F.lit("")), 1, 1000).alias("content"), F.coalesce("source", F.lit("Unknown")).alias("source"))


# Keys: who wins, upserts, differences

_LATEST = "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY coalesce(fetched_at, '') DESC, article_id DESC) AS r FROM articles) WHERE r = 1"


def _latest(t):
    rows = t("articles").withColumn("_at", F.coalesce("fetched_at", F.lit("")))
    return tables.latest(rows, "url", "_at", "article_id").drop("_at")


@query(f"SELECT url, article_id, fetched_at, embedding_status FROM ({_LATEST})")
def latest_per_url(t):
    return _latest(t).select("url", "article_id", "fetched_at", "embedding_status")


_INCOMING = "SELECT url, title, published_date, source FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY concat_ws('|', source, coalesce(published_date, ''), coalesce(title, '')) DESC) AS r FROM discovered_urls WHERE url IS NOT NULL) WHERE r = 1"


@query(f"""
WITH old AS ({_LATEST}), new AS ({_INCOMING})
SELECT url, title, published_date, source, embedding_status, embedded_at FROM old WHERE url NOT IN (SELECT url FROM new)
UNION ALL SELECT url, title, published_date, source, 'pending', NULL FROM new
""")
def upsert_articles(t):
    old = _latest(t).select("url", "title", "published_date", "source", "embedding_status", "embedded_at")
    new = t("discovered_urls").where("url is not null").withColumn("seq", F.concat_ws("|", "source", F.coalesce("published_date", F.lit("")), F.coalesce("title", F.lit(""))))
    return tables.upsert(old, new, "url", "seq", {"embedding_status": F.lit("pending"), "embedded_at": F.lit(None).cast("string")})


@query(f"WITH new AS ({_INCOMING}) SELECT url, source FROM (SELECT DISTINCT url, 'article' AS source FROM articles WHERE url IS NOT NULL) UNION ALL SELECT url, source FROM new WHERE url NOT IN (SELECT url FROM articles WHERE url IS NOT NULL)")
def insert_new_urls(t):
    known = t("articles").where("url is not null").select("url", F.lit("article").alias("source")).distinct()
    new = t("discovered_urls").where("url is not null").withColumn("seq", F.concat_ws("|", "source", F.coalesce("published_date", F.lit("")), F.coalesce("title", F.lit(""))))
    return tables.insert_new(known, new, "url", "seq")


@query("SELECT url, title, source FROM discovered_urls d WHERE NOT EXISTS (SELECT 1 FROM articles a WHERE a.url = d.url)")
def new_urls(t):
    return tables.not_in(t("discovered_urls"), t("articles"), "url").select("url", "title", "source")


@query("SELECT url, title, source FROM discovered_urls d WHERE EXISTS (SELECT 1 FROM articles a WHERE a.url = d.url)")
def known_urls(t):
    return t("discovered_urls").join(t("articles").select("url"), "url", "left_semi").select("url", "title", "source")


_PRIORITY = "CASE source WHEN 'RSS' THEN 0 WHEN 'Atom' THEN 1 ELSE 2 END"


@query(f"SELECT url, source, title FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY {_PRIORITY}, coalesce(title, ''), coalesce(published_date, '')) AS r FROM discovered_urls) WHERE r = 1")
def first_per_url(t):
    rows = t("discovered_urls").withColumns({"p": F.expr(_PRIORITY), "_t": F.coalesce("title", F.lit("")), "_d": F.coalesce("published_date", F.lit(""))})
    return tables.first_of(rows, "url", "p", "_t", "_d").select("url", "source", "title")


@query("SELECT url FROM (SELECT url FROM discovered_urls WHERE source = 'RSS' INTERSECT SELECT url FROM discovered_urls WHERE source = 'Sitemap')")
def urls_in_both(t):
    d = t("discovered_urls")
    return d.where("source = 'RSS'").select("url").intersect(d.where("source = 'Sitemap'").select("url"))


@query("SELECT url, 'feed' AS origin FROM discovered_urls UNION ALL SELECT url, 'article' FROM articles UNION ALL SELECT url, 'extraction' FROM raw_extractions")
def all_urls(t):
    parts = [t(n).select("url", F.lit(o).alias("origin")) for n, o in (("discovered_urls", "feed"), ("articles", "article"), ("raw_extractions", "extraction"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT article_id, CASE WHEN url IN (SELECT url FROM raw_extractions WHERE url IS NOT NULL) THEN 'embedded' ELSE embedding_status END AS embedding_status FROM articles")
def mark_extracted(t):
    keys = t("raw_extractions").where("url is not null")
    return tables.mark(t("articles").select("article_id", "url", "embedding_status"), keys, "url", {"embedding_status": F.lit("embedded")}).select("article_id", "embedding_status")


@query("SELECT article_id, CASE WHEN embedding_status = 'failed' THEN 'pending' ELSE embedding_status END AS embedding_status, CASE WHEN embedding_status = 'failed' THEN NULL ELSE error_message END AS error_message FROM articles")
def reset_failed(t):
    bad = F.col("embedding_status") == "failed"
    return t("articles").select("article_id", F.when(bad, "pending").otherwise(F.col("embedding_status")).alias("embedding_status"), F.when(~F.coalesce(bad, F.lit(False)), F.col("error_message")).alias("error_message"))


# Joins

_LAST = "SELECT url, max_by(raw_json, extraction_id) AS raw_json, max(extraction_id) AS extraction_id FROM raw_extractions WHERE url IS NOT NULL GROUP BY url"


@query(f"WITH last AS ({_LAST}) SELECT a.article_id, a.url, l.extraction_id FROM articles a LEFT JOIN last l ON a.url = l.url")
def map_back(t):
    return extractions.mapped_back(t("articles").select("article_id", "url"), t("raw_extractions")).select("article_id", "url", "extraction_id")


_PLACES = "(SELECT article_id, row_number() OVER (ORDER BY article_id) - 1 AS position FROM articles) a {} JOIN (SELECT extraction_id, row_number() OVER (ORDER BY extraction_id) - 1 AS position FROM raw_extractions) b USING (position)"


@query(f"SELECT position, article_id, extraction_id FROM {_PLACES.format('')}")
def positional_join(t):
    return tables.by_position(t("articles").select("article_id"), t("raw_extractions").select("extraction_id"), "article_id", "extraction_id")


@query(f"SELECT position, article_id, extraction_id FROM {_PLACES.format('LEFT')}")
def positional_left_join(t):
    return tables.by_position(t("articles").select("article_id"), t("raw_extractions").select("extraction_id"), "article_id", "extraction_id", "left")


_SUFFIX = "trim(name)"
for _s in text.LEGAL_SUFFIXES:
    _SUFFIX = f"trim(regexp_replace({_SUFFIX}, '(?i),?\\s+{_s}\\.?$', ''))"


@query(f"WITH n AS (SELECT DISTINCT target AS name FROM deals WHERE target IS NOT NULL UNION SELECT DISTINCT acquirer FROM deals WHERE acquirer IS NOT NULL) SELECT name, {_SUFFIX} AS stripped FROM n")
def strip_suffixes(t):
    n = t("deals").select(F.explode(F.array("target", "acquirer")).alias("name")).where("name is not null").distinct()
    return n.select("name", text.strip_legal_suffixes(F.col("name")).alias("stripped"))


_NORM = "trim(regexp_replace(lower(regexp_replace(strip_accents(replace({c}, chr(160), ' ')), '[^\\x00-\\x7F]', '', 'g')), '\\s+', ' ', 'g'))"


@query(f"""
WITH n AS (SELECT target AS name FROM deals WHERE target IS NOT NULL UNION ALL SELECT acquirer FROM deals WHERE acquirer IS NOT NULL),
s AS (SELECT name, {_SUFFIX} AS stripped FROM n),
d AS (SELECT canonical, variant AS spelling, precedence FROM aliases UNION ALL SELECT canonical, canonical, 0 FROM aliases),
k AS (SELECT {_NORM.format(c="spelling")} AS k, arg_min(canonical, (precedence, canonical)) AS found FROM d GROUP BY 1)
SELECT name, CASE WHEN trim(name) = '' THEN name ELSE coalesce(found, stripped) END AS canonical, count(*) AS n FROM s LEFT JOIN k ON k.k = {_NORM.format(c="stripped")} GROUP BY 1, 2
""")
def canonical_names(t):
    n = t("deals").select(F.explode(F.array("target", "acquirer")).alias("name")).where("name is not null")
    return names.canonical_names(n, t("aliases")).groupBy("name", "canonical").agg(F.count("*").alias("n"))


@query("""
SELECT d.deal_id, d.detected_currency, round((d.total_deal_value_usd * CASE WHEN upper(d.detected_currency) = 'USD' THEN 1 ELSE r.rate END)::DOUBLE, 6) AS usd,
  CASE WHEN upper(d.detected_currency) = 'USD' OR r.rate IS NOT NULL THEN r.source ELSE 'Unavailable' END AS rate_source
FROM deals d LEFT JOIN fx_rates r ON upper(d.detected_currency) = r.currency
""")
def exchange_deals(t):
    rates = t("fx_rates").select("currency", F.col("rate").alias("found"), F.col("source").alias("told"))
    rows = t("deals").join(rates, F.upper("detected_currency") == F.col("currency"), "left")
    x = money.exchange(F.col("total_deal_value_usd"), F.col("detected_currency"), F.col("found"), F.col("told"))
    return rows.select("deal_id", "detected_currency", x.alias("x")).select("deal_id", "detected_currency", F.round(F.col("x.amount").cast("double"), 6).alias("usd"), F.col("x.source").alias("rate_source"))


@query("SELECT (SELECT count(*) FROM articles WHERE embedding_status = 'embedded') AS embedded, (SELECT count(*) FROM embeddings) AS vectors, (SELECT count(*) FROM articles WHERE embedding_status = 'embedded') = (SELECT count(*) FROM embeddings) AS in_sync")
def sync_check(t):
    a = t("articles").agg(F.count_if(F.col("embedding_status") == "embedded").alias("embedded"))
    v = t("embeddings").agg(F.count("*").alias("vectors"))  # a row each
    return a.crossJoin(v).select("embedded", "vectors", (F.col("embedded") == F.col("vectors")).alias("in_sync"))


# Aggregates


@query("SELECT embedding_status, count(*) AS n FROM articles GROUP BY embedding_status")
def count_by_status(t):
    return t("articles").groupBy("embedding_status").agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n, count(DISTINCT url) AS urls, min(fetched_at) AS first_fetched, max(fetched_at) AS last_fetched FROM articles GROUP BY source")
def count_by_source(t):
    return t("articles").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("url").alias("urls"), F.min("fetched_at").alias("first_fetched"), F.max("fetched_at").alias("last_fetched"))


@query("SELECT coalesce(source, 'Unknown') AS source, count(*) AS n FROM (SELECT source FROM articles ORDER BY article_id LIMIT 10000) GROUP BY 1")
def count_first_sources(t):
    head = t("articles").select("article_id", "source").orderBy("article_id").limit(10_000)
    return head.groupBy(F.coalesce("source", F.lit("Unknown")).alias("source")).agg(F.count("*").alias("n"))


@query("SELECT url, max_by(article_id, (length(coalesce(content, '')), -article_id)) AS article_id, max(length(coalesce(content, '')))::BIGINT AS chars, count(*) AS copies FROM articles GROUP BY url")
def longest_copy(t):
    size = F.length(F.coalesce("content", F.lit("")))
    return t("articles").groupBy("url").agg(F.max_by("article_id", F.struct(size, -F.col("article_id"))).alias("article_id"), F.max(size).cast("bigint").alias("chars"), F.count("*").alias("copies"))


@query(f"SELECT count(*) AS stored, count_if(length(coalesce(published_date, '')) >= 10)::BIGINT AS dated, count_if(length(coalesce(published_date, '')) >= 10 AND NOT regexp_matches(coalesce(url, ''), '(?i){_REJECT}'))::BIGINT AS kept_urls, count_if(length(trim(coalesce(content, ''))) >= 500)::BIGINT AS long_enough FROM articles")
def funnel_counts(t):
    dated = filters.valid_date()
    return t("articles").agg(F.count("*").alias("stored"), F.count_if(dated).alias("dated"), F.count_if(dated & ~filters.rejected_url()).alias("kept_urls"), F.count_if(filters.long_enough()).alias("long_enough"))


@query("SELECT count(*) AS processed, count_if(embedding_status = 'embedded')::BIGINT AS succeeded, count_if(embedding_status = 'failed')::BIGINT AS failed, round(100.0 * count_if(embedding_status = 'embedded') / count(*), 4)::DOUBLE AS percent FROM articles WHERE embedding_status <> 'pending'")
def progress(t):
    done = t("articles").where("embedding_status <> 'pending'")
    ok = F.count_if(F.col("embedding_status") == "embedded")
    return done.agg(F.count("*").alias("processed"), ok.alias("succeeded"), F.count_if(F.col("embedding_status") == "failed").alias("failed"), F.round(F.lit(100.0) * ok / F.count("*"), 4).alias("percent"))


@query("WITH v AS (SELECT url, count(DISTINCT source) AS yes_count FROM discovered_urls GROUP BY url) SELECT yes_count, count(*) AS urls, count_if(yes_count >= 2)::BIGINT AS consensus FROM v GROUP BY yes_count")
def vote_histogram(t):
    v = t("discovered_urls").groupBy("url").agg(F.countDistinct("source").alias("yes_count"))
    return v.groupBy("yes_count").agg(F.count("*").alias("urls"), F.count_if(F.col("yes_count") >= 2).alias("consensus"))


@query("SELECT deal_id, coalesce(total_deal_value_usd, upfront_value_usd + contingent_payment_usd)::DOUBLE AS total, coalesce(abs(total_deal_value_usd - (upfront_value_usd + contingent_payment_usd)) > 1.0, false) AS mismatch FROM deals")
def deal_totals(t):
    parts = F.col("upfront_value_usd") + F.col("contingent_payment_usd")
    total = F.coalesce("total_deal_value_usd", parts).cast("double")
    return t("deals").select("deal_id", total.alias("total"), F.coalesce(F.abs(F.col("total_deal_value_usd") - parts) > 1, F.lit(False)).alias("mismatch"))


# Batches and windows


@query("SELECT article_id, ((row_number() OVER (ORDER BY article_id) - 1) // 40)::BIGINT AS batch FROM articles")
def batches_of_rows(t):
    return tables.batches(t("articles").select("article_id"), 40, "article_id").select("article_id", F.col("batch").cast("bigint").alias("batch"))


@query("""
WITH s AS (SELECT user_id, epoch(date_trunc('second', ts))::BIGINT AS t, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, t, n, sum(n) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)::BIGINT AS in_window FROM s
""")
def sliding_rate(t):
    return tables.sliding_count(t("events"), "user_id", "ts", 60)


# Vectors

_COS = "round(list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) / sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]) * list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])), 6)"
_HITS = f"SELECT e.vec_id, e.label, {_COS} AS similarity, round(1 - {_COS}, 6) AS distance FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q"


def _first_vector(t) -> list[float]:
    return t("embeddings").orderBy("vec_id").select("embedding").first()[0]


@query(f"SELECT vec_id, similarity, distance FROM (SELECT * FROM ({_HITS}) ORDER BY distance, vec_id LIMIT 300) WHERE similarity >= 0.1 AND label <> 3 ORDER BY distance, vec_id LIMIT 100")
def vector_search(t):
    return vectors.search(t("embeddings"), _first_vector(t), 100, least=0.1, keep=F.col("label") != 3).select("vec_id", "similarity", "distance")


@query(f"SELECT vec_id, similarity, distance FROM ({_HITS}) WHERE similarity >= 0.1 AND label <> 3 ORDER BY distance, vec_id LIMIT 100")
def vector_search_exact(t):
    return vectors.search(t("embeddings"), _first_vector(t), 100, least=0.1, keep=F.col("label") != 3, exact=True).select("vec_id", "similarity", "distance")


@query(f"WITH a AS (SELECT * FROM ({_HITS}) ORDER BY distance, vec_id LIMIT 200), b AS (SELECT e.vec_id FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id DESC LIMIT 1) q ORDER BY round(1 - {_COS}, 6), e.vec_id LIMIT 200) SELECT vec_id, similarity FROM a WHERE vec_id IN (SELECT vec_id FROM b) ORDER BY distance, vec_id LIMIT 50")
def dual_vector_search(t):
    e = t("embeddings")
    other = e.orderBy(F.desc("vec_id")).select("embedding").first()[0]
    return vectors.both_searches(vectors.search(e, _first_vector(t), 200), vectors.search(e, other, 200), 50).select("vec_id", "similarity")


@query(f"SELECT query_id, id, similarity, rank FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, {_COS} AS similarity, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COS} DESC, e.vec_id) AS rank FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 20")
def vector_neighbours(t):
    e = t("embeddings")
    return vectors.neighbours(e.where("vec_id % 50 = 0"), e, 20).select("query_id", "id", "similarity", F.col("rank").cast("bigint").alias("rank"))


@query()
def greedy_distinct(t):
    hits = vectors.search(t("embeddings"), _first_vector(t), 1000, exact=True, carry=("label", "embedding"))
    rows = hits.select(F.col("vec_id").alias("id"), F.col("distance").alias("ord"), (F.col("label").cast("bigint") * 100 + F.col("vec_id") % 7).alias("length"), "embedding")
    return vectors.greedy_distinct(rows, above=0.3)


# Extractions

_AMOUNT = r"(?i)([€£$¥])?\s*(\d+(?:\.\d+)?)\s*(million|billion|M|B)"
_IS_EXTRACTION = "coalesce(json_type({j}) = 'OBJECT' AND list_has_any(json_keys({j}), ['money', 'parties', 'key_evidence']), false)"
#: Replies cut into their extractions, level by level.
_FOUND = f"""
WITH RECURSIVE x AS (
  SELECT extraction_id AS eid, url, raw_json::JSON AS j, 0 AS depth FROM raw_extractions WHERE json_valid(raw_json)
  UNION ALL SELECT x.eid, x.url, e.value AS j, x.depth + 1 AS depth FROM x, json_each(x.j) e WHERE x.depth < 4 AND json_type(x.j) IN ('ARRAY', 'OBJECT') AND NOT {_IS_EXTRACTION.format(j="x.j")}
),
f AS (SELECT eid, url, j FROM x WHERE {_IS_EXTRACTION.format(j="j")}),
r AS (SELECT eid AS extraction_id, url, j FROM f UNION ALL SELECT extraction_id, url, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END FROM raw_extractions WHERE extraction_id NOT IN (SELECT eid FROM f))
"""
_NUM = r"CASE WHEN regexp_matches(m, '^\s*[-+]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?\s*$') AND m::DOUBLE >= 0 THEN m::DOUBLE END"


def _num(path: str) -> str:
    return _NUM.replace("m::", f"(j->>'{path}')::").replace("(m,", f"(j->>'{path}',")


_PARSED = _FOUND + f""",
m AS (SELECT extraction_id, j, coalesce(j->>'$.url', url) AS url, j->>'$.parties.target' AS target, j->>'$.parties.acquirer' AS acquirer, {_num("$.money.upfront_value")} AS upfront_value, {_num("$.money.contingent_payment")} AS contingent_payment,
  {_num("$.money.total_deal_value")} AS stated, j->>'$.money.currency' AS said, j->>'$.deal_type' AS deal_type, j->>'$.date_announced' AS date_announced, coalesce(j->>'$.key_evidence', '') AS evidence, j->>'$.geography' AS geography,
  CASE WHEN list_contains(json_keys(j), 'stage') THEN j->>'$.stage' ELSE 'unknown' END AS stage, CASE WHEN list_contains(json_keys(j), 'asset_focus') THEN j->>'$.asset_focus' ELSE 'Undisclosed' END AS asset_focus,
  CASE WHEN list_contains(json_keys(j), 'confidence') THEN j->>'$.confidence' ELSE 'medium' END AS sure FROM r),
e AS (SELECT *, CASE WHEN coalesce(upfront_value, contingent_payment, stated) IS NULL THEN evidence ELSE '' END AS told FROM m),
t AS (SELECT *, regexp_extract(told, '{_AMOUNT}', 1) AS s, regexp_extract(told, '{_AMOUNT}', 2) AS n, lower(regexp_extract(told, '{_AMOUNT}', 3)) AS u FROM e),
p AS (SELECT *, coalesce(stated, CASE WHEN n <> '' THEN n::DOUBLE * CASE WHEN u IN ('b', 'billion') THEN 1000 ELSE 1 END END, upfront_value + contingent_payment) AS total_deal_value,
  CASE WHEN n <> '' THEN CASE s WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' WHEN '¥' THEN 'JPY' ELSE 'USD' END ELSE coalesce(said, 'USD') END AS currency FROM t)
"""


@query(_PARSED + "SELECT extraction_id, target, acquirer, upfront_value, contingent_payment, total_deal_value, currency, stage, asset_focus, geography FROM p")
def parse_extractions(t):
    return extractions.parsed(t("raw_extractions")).select("extraction_id", "target", "acquirer", "upfront_value", "contingent_payment", "total_deal_value", "currency", "stage", "asset_focus", "geography")


@query(_PARSED + r""",
v AS (SELECT *, CASE WHEN regexp_matches(date_announced, '^\d{4}-\d{2}-\d{2}([T ].*)?$') THEN try_cast(substr(date_announced, 1, 10) AS DATE) END AS d FROM p)
SELECT extraction_id, d::VARCHAR AS day, nullif(total_deal_value, 0) AS total_deal_value, coalesce(abs(total_deal_value - upfront_value - contingent_payment) > 1, false) AS total_mismatch,
  CASE sure WHEN 'high' THEN 0.9 WHEN 'low' THEN 0.5 ELSE 0.7 END::DOUBLE AS confidence,
  CASE WHEN j IS NULL THEN 'null_extraction' WHEN url IS NULL THEN 'parse_failed'
    WHEN target IS NULL OR acquirer IS NULL OR d IS NULL OR coalesce(deal_type, '') NOT IN ('M&A', 'partnership', 'licensing', 'option-to-license') OR stage IS NULL OR asset_focus IS NULL OR NOT regexp_matches(url, '(?i)^https?://[^/]+') THEN 'model_error' END AS reject_reason
FROM v
""")
def route_rejects(t):
    rows = extractions.validated(extractions.parsed(t("raw_extractions")))
    return rows.select("extraction_id", "reject_reason", F.col("day").cast("string").alias("day"), "total_deal_value", "total_mismatch", extractions.confidence_value(F.col("confidence")).cast("double").alias("confidence"))


_SHEET = {
    "date_announced": "date_announced::VARCHAR", "target": "target", "acquirer": "acquirer", "upfront_value_usd": "nullif(upfront_value_usd::DOUBLE, 0)", "contingent_payment_usd": "nullif(contingent_payment_usd::DOUBLE, 0)",
    "total_deal_value_usd": "nullif(total_deal_value_usd::DOUBLE, 0)", "upfront_pct_total": "nullif(upfront_pct_total::DOUBLE, 0)", "stage": "stage", "therapeutic_area": "therapeutic_area", "secondary_areas": "secondary_areas", "asset_focus": "asset_focus",
    "deal_type": "CASE WHEN deal_type_detailed = 'M&A' THEN 'M&A' ELSE 'Partnership' END", "geography": "geography", "source_url": "source_url", "needs_review": "CASE WHEN needs_review THEN 'TRUE' ELSE 'FALSE' END",
}


@query("SELECT deal_id, " + ", ".join(f'{e} AS "{c}"' for c, e in _SHEET.items()) + " FROM deals")
def sheet_columns(t):
    sheet = sheets.sheet_rows(t("deals"), ["deal_id"])
    return sheet.select("deal_id", *(F.col(f"`{h}`").alias(c) for h, c in sheets.HEADERS.items()))


@query(" UNION ALL ".join(f"SELECT '{h}' AS header, least(greatest(coalesce(max(length({_SHEET[c]})), 0), {len(h)}) + 2, 50)::BIGINT AS width FROM deals" for h, c in sheets.HEADERS.items() if not c.endswith(("_usd", "_total"))))
def sheet_widths(t):
    told = [h for h, c in sheets.HEADERS.items() if not c.endswith(("_usd", "_total"))]
    return sheets.column_widths(sheets.sheet_rows(t("deals")).select(*(F.col(f"`{h}`") for h in told)))


@query("""
SELECT to_json({'canonical_key': canonical_key, 'source_url': source_url, 'related_urls': related_urls, 'evidence': json('{}'), 'detected_currency': detected_currency, 'fx_rate': nullif(fx_rate::DOUBLE, 0), 'fx_source': fx_source,
  'confidence': confidence::DOUBLE, 'inclusion_reason': inclusion_reason, 'exclusion_reason': exclusion_reason, 'parser_version': parser_version, 'timestamp_utc': timestamp_utc})::VARCHAR AS value FROM deals
""")
def evidence_records(t):
    return sheets.evidence_lines(t("deals"))


# Text

_SENT = "coalesce(substring(content, 1), '')"


@query(f"SELECT article_id, CASE WHEN instr(lower(c), 'upfront') = 0 THEN substring(c, 1, 160) ELSE (CASE WHEN instr(lower(c), 'upfront') > 81 THEN '...' ELSE '' END) || substring(c, greatest(1, instr(lower(c), 'upfront') - 80), least(length(c), instr(lower(c), 'upfront') - 1 + 87) - greatest(1, instr(lower(c), 'upfront') - 80) + 1) || (CASE WHEN least(length(c), instr(lower(c), 'upfront') - 1 + 87) < length(c) THEN '...' ELSE '' END) END AS snippet FROM (SELECT article_id, content AS c FROM articles WHERE content IS NOT NULL)")
def snippets(t):
    return t("articles").where("content is not null").select("article_id", text.extract_snippet(F.col("content"), "upfront", 80).alias("snippet"))


_DATES = ", ".join(f"nullif(regexp_extract(content, '(?i){p}', 0), '')" for p in text.DATE_PATTERNS)


@query(f"SELECT article_id, coalesce({_DATES}) AS found FROM articles WHERE content IS NOT NULL")
def dates_in_text(t):
    return t("articles").where("content is not null").select("article_id", text.date_from_text(F.col("content")).alias("found"))


@query(f"""
WITH m AS (SELECT article_id, regexp_extract(content, '{_AMOUNT}', 1) AS s, regexp_extract(content, '{_AMOUNT}', 2) AS n, lower(regexp_extract(content, '{_AMOUNT}', 3)) AS u FROM articles WHERE content IS NOT NULL)
SELECT article_id, round(n::DOUBLE * CASE WHEN u IN ('b', 'billion') THEN 1000 ELSE 1 END, 6) AS value, CASE s WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' WHEN '¥' THEN 'JPY' ELSE 'USD' END AS currency FROM m WHERE n <> ''
""")
def first_amounts(t):
    rows = t("articles").where("content is not null").select("article_id", money.first_amount(F.col("content")).alias("m"))
    return rows.where("m is not null").select("article_id", F.round("m.value", 6).alias("value"), "m.currency")


_COUNTRY = " ".join(f"WHEN regexp_matches(x, '(?i)\\b(?:{w})\\b') THEN '{c}'" for c, w in text.COUNTRY_WORDS.items())


@query(f"SELECT article_id, CASE {_COUNTRY} END AS country FROM (SELECT article_id, coalesce(title, '') || ' ' || coalesce(content, '') AS x FROM articles)")
def countries_in_text(t):
    x = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))
    return t("articles").select("article_id", text.country_from_text(x).alias("country"))


_DOMAIN = " ".join(f"WHEN contains(lower(url), '{d}') THEN '{c}'" for d, c in text.COUNTRY_DOMAINS.items())


@query(f"SELECT article_id, CASE {_DOMAIN} END AS country, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain FROM articles WHERE url IS NOT NULL")
def countries_of_urls(t):
    return t("articles").where("url is not null").select("article_id", text.country_from_url(F.col("url")).alias("country"), text.domain(F.col("url")).alias("domain"))


@query(r"SELECT deal_id, regexp_matches(lower(stage), 'phase\s*1\s*[/\-]\s*2') AS ambiguous, lower(stage) AS stage FROM deals WHERE stage IS NOT NULL")
def ambiguous_stages(t):
    return t("deals").where("stage is not null").select("deal_id", text.is_ambiguous_stage(F.col("stage")).alias("ambiguous"), F.lower("stage").alias("stage"))


_NOISE = "lower(content)"
for _w in text.AMOUNT_NOISE:
    _NOISE = f"regexp_replace({_NOISE}, '\\b{_w}\\b', '', 'g')"


@query(f"SELECT article_id, md5(trim(replace({_NOISE}, ',', ''), ' ')) AS cleaned FROM articles WHERE content IS NOT NULL")
def cleaned_amounts(t):
    return t("articles").where("content is not null").select("article_id", F.md5(text.clean_amount_text(F.col("content"))).alias("cleaned"))


@query("WITH d AS (SELECT article_id, coalesce(title, '') || ' ' || substring(coalesce(content, ''), 1, 2500) AS doc FROM articles) SELECT article_id, md5(doc) AS document, md5(CASE WHEN instr(doc, ' ') > 0 THEN substring(doc, instr(doc, ' ') + 1) ELSE '' END) AS snippet FROM d")
def documents_and_snippets(t):
    rows = t("articles").select("article_id", text.document_text(F.col("title"), F.col("content")).alias("doc"))
    return rows.select("article_id", F.md5("doc").alias("document"), F.md5(text.snippet_of(F.col("doc"))).alias("snippet"))


@query("SELECT therapeutic_area, lower(substring(therapeutic_area, 1, n)) AS prefix FROM (SELECT DISTINCT therapeutic_area FROM deals WHERE length(therapeutic_area) >= 3), LATERAL (SELECT unnest(generate_series(3, length(therapeutic_area))) AS n)")
def keyword_prefixes(t):
    areas = t("deals").where("length(therapeutic_area) >= 3").select("therapeutic_area").distinct()
    return areas.select("therapeutic_area", F.explode(text.prefixes(F.col("therapeutic_area"))).alias("prefix"))


@query("SELECT doc_id, md5(coalesce(lang, 'unknown') || ':en:' || text) AS cache_key FROM documents WHERE text IS NOT NULL")
def translation_keys(t):
    return t("documents").where("text is not null").select("doc_id", text.cache_key(F.coalesce("lang", F.lit("unknown")), F.lit("en"), F.col("text")).alias("cache_key"))


@query("SELECT event_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || ((s % 3600) // 60) || 'm' END AS took FROM (SELECT event_id, (event_id * 37 % 20000)::BIGINT AS s FROM events)")
def durations(t):
    return t("events").select("event_id", text.duration((F.col("event_id") * 37 % 20000)).alias("took"))


@query("SELECT deal_id, (date_announced - CASE isodow(date_announced) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END)::DATE::VARCHAR AS business_day, strftime(date_trunc('month', date_announced), '%Y-%m-%d') AS month FROM deals WHERE date_announced IS NOT NULL")
def business_days(t):
    d = F.col("date_announced")
    return t("deals").where(d.isNotNull()).select("deal_id", money.previous_business_day(d).cast("string").alias("business_day"), F.date_format(F.trunc(d, "month"), "yyyy-MM-dd").alias("month"))


@query(f"SELECT article_id, {_NORM.format(c='title')} AS title FROM articles")
def normalized_titles(t):
    return t("articles").select("article_id", text.normalize_text("title").alias("title"))


@query("SELECT host, strftime(m, '%Y-%m-%d') AS month, 'https://' || host || '/archives/' || strftime(m, '%Y/%m') AS url FROM sites, LATERAL (SELECT unnest(generate_series(DATE '2021-01-01', DATE '2022-06-01', INTERVAL 1 MONTH)) AS m)")
def archive_pages(t):
    sites = t("sites")
    months = feeds.archive_months("/archives/{year}/{month}", "2021-01-15", "2022-06-10", sites.sparkSession)
    # Months of a span are few: they are a column of every host, not a join.
    every = months.agg(F.sort_array(F.collect_list(F.struct("month", "url"))).alias("m")).first()[0]
    listed = F.explode(F.array(*(F.struct(F.lit(m.month).alias("month"), F.lit(m.url).alias("url")) for m in every)))
    return sites.select("host", listed.alias("m")).select("host", "m.*").select("host", "month", F.concat(F.lit("https://"), "host", "url").alias("url"))


@query(r"SELECT article_id, strftime(strptime(regexp_replace(published_date, '^[A-Za-z]{3}, ', ''), '%d %b %Y %H:%M:%S GMT'), '%Y-%m-%d %H:%M:%S') AS at FROM articles WHERE regexp_matches(published_date, '^[A-Z][a-z]{2}, \d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} GMT$')")
def feed_times(t):
    p = F.col("published_date")
    return t("articles").where(p.rlike(r"^[A-Z][a-z]{2}, \d{1,2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} GMT$")).select("article_id", F.date_format(feeds.rfc_time(p), "yyyy-MM-dd HH:mm:ss").alias("at"))


# Feeds, as XML and back

_FEED_DAY = "CASE WHEN regexp_matches(published_date, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z$') THEN substr(published_date, 1, 10) END"


def _feed_sql(source: str, title: str) -> str:
    return f"SELECT trim(url) AS url, {title} AS title, {_FEED_DAY} AS published_date, '{source}' AS source FROM discovered_urls WHERE url IS NOT NULL AND source = '{source}' AND coalesce({_FEED_DAY}, '9') >= '2021-01-01'"


def _as_xml(t, source: str, root: str, tag: str, cols: dict[str, str]) -> tuple[SparkSession, list[str]]:
    """The urls of one source as a feed's XML in the shared folder."""
    rows = t("discovered_urls").where(F.col("source") == source)
    utc = F.when(F.col("published_date").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.to_timestamp("published_date"))
    rows = rows.withColumns({"iso": F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "rfc": F.date_format(utc, "EEE, d MMM yyyy HH:mm:ss 'GMT'"), "link": F.struct(F.col("url").alias("_href"))})
    path = f"{shared_dir(rows.sparkSession)}/tidemark/{source}-{uuid.uuid4().hex}"
    rows.select(*(F.col(c).alias(x) for x, c in cols.items())).write.format("xml").option("rootTag", root).option("rowTag", tag).save(path)
    return rows.sparkSession, [path]


@query(_feed_sql("RSS", "trim(coalesce(title, ''))"))
def rss_entries(t):
    return feeds.rss(*_as_xml(t, "RSS", "channel", "item", {"title": "title", "link": "url", "pubDate": "rfc"}), "2021-01-01")


@query(_feed_sql("Atom", "trim(coalesce(title, ''))"))
def atom_entries(t):
    return feeds.atom(*_as_xml(t, "Atom", "feed", "entry", {"title": "title", "link": "link", "updated": "iso"}), "2021-01-01")


@query(_feed_sql("Sitemap", "''"))
def sitemap_entries(t):
    return feeds.sitemap(*_as_xml(t, "Sitemap", "urlset", "url", {"loc": "url", "lastmod": "iso"}), "2021-01-01")


# Single functions over whole columns


@query("SELECT deal_id, CASE " + " ".join(f"WHEN lower(stage) IN ({', '.join(repr(w) for w in words)}) THEN '{name}'" for name, words in funnel.BUCKETS.items()) + " END AS bucket FROM deals")
def stage_buckets(t):
    return t("deals").select("deal_id", funnel.stage_bucket().alias("bucket"))


@query("SELECT deal_id, array_to_string(list_filter(list_transform(string_split(secondary_areas, ';'), lambda x: trim(x)), lambda x: x <> ''), '|') AS keywords FROM deals WHERE secondary_areas IS NOT NULL")
def checked_keywords(t):
    words = filters.checked_keywords(F.split("secondary_areas", ";"))
    return t("deals").where("secondary_areas is not null").select("deal_id", F.array_join(words, "|").alias("keywords"))


@query(r"SELECT doc_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '[\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{001C}-\x{001F}]', ' ', 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', '')), lambda x: x <> ''), ' ') AS content FROM documents WHERE text IS NOT NULL")
def html_texts(t):
    """Each document as a page with a paragraph a line, read back as text."""
    spaces = F.regexp_replace("text", r"[\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{001C}-\x{001F}]", " ")
    escaped = F.replace(F.replace(spaces, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(F.lit("<html><head><style>p {}</style></head><body><p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><script>var a;</script><p>")), F.lit("</p></body></html>"))
    return t("documents").where("text is not null").select("doc_id", text.html_text(page).alias("content"))


@query(f"SELECT article_id, regexp_replace(url, '[^/]*$', '') AS section, regexp_matches(regexp_replace(coalesce(url, ''), '[^/]*$', ''), '(?i){_REJECT}') AS rejected FROM articles")
def rejected_sections(t):
    """The url's section, as a listing's url, by the patterns: some hit."""
    return t("articles").withColumn("section", F.regexp_replace("url", "[^/]*$", "")).select("article_id", "section", filters.rejected_url("section").alias("rejected"))


@query("""
WITH d AS (SELECT count(*) AS total, count_if(embedding_status = 'pending')::BIGINT AS pending, count_if(embedding_status = 'failed')::BIGINT AS failed, count_if(embedding_status <> 'pending')::BIGINT AS processed FROM articles)
SELECT total, pending, failed, processed, round(processed * 3600.0 / 1800, 4)::DOUBLE AS per_hour, CASE WHEN processed > 0 THEN round(pending * 1800.0 / processed, 4)::DOUBLE END AS eta_seconds FROM d
""")
def status_snapshot(t):
    return tables.status_snapshot(t("articles"), 1800.0)


@query("""
WITH v AS (SELECT url, list(DISTINCT source) AS said FROM discovered_urls WHERE url IS NOT NULL GROUP BY url)
SELECT url, len(said)::BIGINT AS yes_count, array_to_string(list_sort(said), '|') AS voters, len(said) >= 2 AS consensus FROM v
""")
def consensus_groups(t):
    v = t("discovered_urls").where("url is not null").groupBy("url").agg(F.sort_array(F.collect_set("source")).alias("said"))
    return v.select("url", F.size("said").cast("bigint").alias("yes_count"), F.array_join("said", "|").alias("voters"), (F.size("said") >= 2).alias("consensus"))


@query("""
WITH r AS (SELECT currency, DATE '2018-01-01' + (7 * i)::INTEGER AS day, (rate::DOUBLE * (1 + i / 1000.0)) AS rate FROM fx_rates, LATERAL (SELECT unnest(range(0, 400)) AS i))
SELECT d.deal_id, upper(d.detected_currency) || '_' || d.date_announced::VARCHAR AS cache_key, round((SELECT arg_max(r.rate, r.day) FROM r WHERE r.currency = upper(d.detected_currency) AND r.day BETWEEN d.date_announced - 7 AND d.date_announced), 8) AS rate
FROM deals d WHERE d.date_announced IS NOT NULL AND d.detected_currency IS NOT NULL
""")
def rates_as_of(t):
    """Weekly rates made from the table, the latest of the week before each deal."""
    weekly = t("fx_rates").select("currency", F.posexplode(F.sequence(F.lit(0), F.lit(399))).alias("i", "_i"), "rate")
    weekly = weekly.select("currency", F.date_add(F.lit("2018-01-01").cast("date"), F.col("i") * 7).alias("day"), (F.col("rate").cast("double") * (1 + F.col("i") / 1000.0)).alias("rate"))
    rows = t("deals").where("date_announced is not null and detected_currency is not null").select("deal_id", F.upper("detected_currency").alias("currency"), F.col("date_announced").alias("day"))
    found = money.as_of(rows, weekly, "currency", "day", 7)
    return found.select("deal_id", F.concat_ws("_", "currency", "day").alias("cache_key"), F.round("rate", 8).alias("rate"))
