"""Queries over web pages: text of markup, links, inline scripts, URLs and signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions import text
from tallyboard.operators import discovery
from tallyboard.plans.registry import query, read
from tallyboard.sources import layouts


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages")


_SPACE = r"[\s\x{00a0}\x{feff}]+"


def _strip(column: str) -> str:
    out = column
    for pattern in ("<script[^>]*>.*?</script>", "<style[^>]*>.*?</style>", "<[^>]+>"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'gsi')"
    for name, value in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("nbsp", " "), ("ndash", "-"), ("mdash", "-"), ("minus", "-"), ("cent", "c"), ("deg", " "), ("amp", "&")):
        out = f"regexp_replace({out}, '&{name};', '{value}', 'gi')"
    return f"trim(regexp_replace({out}, '{_SPACE}', ' ', 'g'))"


@query(f"SELECT page_id, {_strip('html')} AS text FROM pages")
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query("SELECT page_id, 'a' || chr(8364) || 'A' || (page_id % 7) || '&lt; <' || CASE WHEN page_id % 2 = 0 THEN '&' ELSE '&bogus;' END AS decoded FROM pages")
def decode_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("a&#x20AC;&#65;"), (F.col("page_id") % 7).cast("string"), F.lit("&amp;lt; &LT;"), F.when(F.col("page_id") % 2 == 0, "&amp;").otherwise("&bogus;"))
    return pages(spark, sf_dir).select("page_id", text.decode_entities(raw).alias("decoded"))


@query(f"SELECT page_id, array_to_string(list_transform(regexp_extract_all(html, '<li[^>]*>(.*?)</li>', 1, 'si'), lambda x: {_strip('x')}), '|') AS cells FROM pages")
def li_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", F.array_join(layouts._items(F.col("html")), "|").alias("cells"))


@query("SELECT page_id, len(list_distinct(regexp_extract_all(html, '<a[^>]+href=[\"'']([^\"'']+)[\"'']', 1))) AS links FROM pages")
def nav_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", F.size(discovery.assets(F.col("html"), "a", "href")).cast("long").alias("links"))


@query(f"SELECT page_id, nullif({_strip('list_extract(regexp_extract_all(html, ' + chr(39) + '<h[1-6][^>]*>(.*?)</h[1-6]>' + chr(39) + ', 1, ' + chr(39) + 'si' + chr(39) + '), -1)')}, '') AS heading FROM pages")
def heading_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", layouts.last_heading(F.col("html")).alias("heading"))


@query("SELECT page_id, 't = \"</p>\"' AS assignments, 1 AS scripts FROM pages")
def inline_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("html")
    return pages(spark, sf_dir).select("page_id", F.array_join(discovery.inline_assignments(h), "|").alias("assignments"), F.size(discovery.inline_scripts(h)).alias("scripts"))


@query("SELECT page_id, 'var apiKey = 1; ' || repeat('x', 84) || chr(10) || chr(8230) || '[' || 16 || ' more chars]' AS block FROM pages")
def config_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    script = F.concat("html", F.lit("<script>  var apiKey = 1; "), F.repeat(F.lit("x"), F.lit(100)), F.lit(" </script>"))
    return pages(spark, sf_dir).select("page_id", F.get(discovery.config_blocks(script, 100), F.lit(0)).alias("block"))


@query(
    """WITH t AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS t FROM pages)
    SELECT page_id, array_to_string(list_transform(regexp_extract_all(lower(t), '[a-z0-9_]+|[^a-z0-9_]+'), lambda w: CASE WHEN regexp_matches(w, '^[a-z]') THEN upper(w[1:1]) || w[2:] ELSE w END), '') AS title FROM t"""
)
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return pages(spark, sf_dir).select("page_id", text.title_case(t).alias("title"))


@query(f"SELECT page_id, substr(trim(regexp_replace(html, '{_SPACE}', ' ', 'g')), 1, 120) AS head FROM pages")
def clean_120(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", text.clean(F.col("html")).alias("head"))


@query("SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM pages")
def escape_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", text.escape_html(F.col("html")).alias("escaped"))


_HOST = "lower(regexp_extract(url, '^https?://([^/?#:]+)', 1))"
_PATH = "coalesce(nullif(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), ''), '/') || regexp_extract(url, '(\\?[^#]*)', 1)"


@query(f"SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages")
def url_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", text.host(F.col("url")).alias("host"), text.path(F.col("url")).alias("path"))


@query("SELECT page_id, url || ' ' || CASE WHEN url LIKE '%://www.%' THEN replace(url, '://www.', '://') ELSE replace(url, '://', '://www.') END AS urls FROM pages")
def url_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("page_id", F.array_join(text.url_twins(F.col("url")), " ").alias("urls"))


@query("SELECT page_id, split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'site_key=<redacted>&a=1' AS redacted FROM pages")
def redact_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    joint = F.when(F.col("url").contains("?"), "&").otherwise("?")
    secret = F.concat(F.split_part("url", F.lit("#"), F.lit(1)), joint, F.lit("site_key="), F.col("page_id").cast("string"), F.lit("&a=1"))
    return pages(spark, sf_dir).select("page_id", text.redact_url(secret).alias("redacted"))


@query("SELECT page_id, substr('{\"token\": \"<redacted>\", \"n\": ' || page_id || '} ' || repeat('ab ', 20), 1, 40) || chr(8230) || ' [+' || (length('{\"token\": \"<redacted>\", \"n\": ' || page_id || '} ' || repeat('ab ', 20)) - 41) || ' more]' AS peek FROM pages")
def peek_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat(F.lit('{"token": "s3cr3t",  "n": '), F.col("page_id").cast("string"), F.lit("}\n"), F.repeat(F.lit("ab "), F.lit(20)))
    return pages(spark, sf_dir).select("page_id", text.peek(body, 40).alias("peek"))


_CRAWL = """crawl AS (SELECT page_id % 25 AS page, page_id AS n,
    CASE page_id % 6 WHEN 0 THEN 'https://api.dtn.com/markets/sites/E' || (page_id % 3) || '/cash-bids?units=us' WHEN 1 THEN 'https://centre.bushelops.com/v1/GetBidsList' WHEN 2 THEN 'https://x.stonex.com/bids?key=1'
      WHEN 3 THEN 'https://www.barchart.com/app.js' ELSE url END AS url,
    CASE page_id % 6 WHEN 3 THEN 'text/javascript' WHEN 4 THEN 'text/html' ELSE 'application/json' END AS mime, CASE WHEN page_id % 11 = 0 THEN 404 ELSE 200 END AS status,
    CASE WHEN page_id % 12 = 0 THEN NULL ELSE html END AS body FROM pages)
"""


def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _CRAWL.replace("FROM pages", "FROM {pages}")
    rows = spark.sql(f"WITH {own} SELECT * FROM crawl", pages=pages(spark, sf_dir))
    return rows.withColumns({"bytes": F.length("body"), "truncated": F.lit(False)})


_SIGNED = """signed AS (SELECT *, CASE WHEN url LIKE 'https://api.dtn.com/markets/sites/%/cash-bids%' THEN 'dtn-cs' WHEN regexp_matches(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), 'stonex') THEN 'stonehedge'
   WHEN regexp_matches(url, '^https?://[^/]*barchart\\.com/') THEN 'barchart' WHEN regexp_matches(url, '^https?://[^/]*bushelops\\.com/') THEN 'bushel' END AS platform FROM crawl)"""


@query(f"WITH {_CRAWL}, {_SIGNED} SELECT n, url, platform FROM signed")
def signature_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl(spark, sf_dir).select("n", "url", discovery.signature(F.col("url")).alias("platform"))


@query(
    f"""WITH {_CRAWL}, scored AS (SELECT *, CASE WHEN regexp_matches(mime, 'json|xml|csv') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(url, '(?i)\\b(bid|bids|cash|grain|market|quote|price|cashgrid|component)\\b') THEN 3 ELSE 0 END
      + CASE WHEN length(body) > 400 THEN 1 ELSE 0 END - CASE WHEN regexp_matches(url, '(?i)\\.(js|css|png|svg|woff2?)(\\?|$)') THEN 4 ELSE 0 END AS score FROM crawl WHERE status BETWEEN 200 AND 399),
    r AS (SELECT page, n, score, row_number() OVER (PARTITION BY page ORDER BY score DESC, coalesce(length(body), 0) DESC, n) AS rank FROM scored WHERE score > 0) SELECT page, n, CAST(score AS BIGINT) AS score, rank FROM r WHERE rank <= 3"""
)
def top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discovery.candidates(crawl(spark, sf_dir), "page", 3)
    return found.select("page", "n", F.col("score").cast("long").alias("score"), F.col("rank").cast("long").alias("rank"))


@query(
    f"""WITH {_CRAWL}, {_SIGNED}, i AS (SELECT *, CASE platform WHEN 'dtn-cs' THEN regexp_extract(url, '/sites/([^/]+)/', 1) WHEN 'bushel' THEN 'GetBidsList' END AS ident FROM signed WHERE platform IS NOT NULL)
    SELECT page, platform, ident, arg_min(n, (body IS NULL, n)) AS n, length(arg_min(coalesce(body, ''), (body IS NULL, n))) AS bytes FROM i GROUP BY 1, 2, 3"""
)
def feed_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = crawl(spark, sf_dir)
    found = discovery.feeds(rows.withColumn("url", F.col("url")), "page")
    first = rows.withColumn("platform", discovery.signature(F.col("url"))).groupBy("page", "platform", "url", "body").agg(F.min("n").alias("n"))
    joined = found.alias("f").join(first.alias("r"), (F.col("f.page") == F.col("r.page")) & (F.col("f.url") == F.col("r.url")) & F.col("f.body").eqNullSafe(F.col("r.body")))
    return joined.select("f.page", "f.platform", "f.ident", "r.n", F.coalesce("f.bytes", F.lit(0)).cast("long").alias("bytes"))


@query(
    f"""WITH {_CRAWL}, {_SIGNED}, p AS (SELECT page, count(DISTINCT (platform, CASE platform WHEN 'dtn-cs' THEN regexp_extract(url, '/sites/([^/]+)/', 1) WHEN 'bushel' THEN 'GetBidsList' ELSE '' END)) FILTER (platform IS NOT NULL AND page % 3 <> 1) AS n_feeds FROM signed GROUP BY 1)
    SELECT page, CASE WHEN n_feeds > 0 THEN 'feeds' WHEN page % 4 = 1 THEN 'unreachable' ELSE 'no-platform' END AS kind, n_feeds FROM p"""
)
def page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = (F.col("page") % 3 == 1) & (F.col("n") % 6 < 4)
    rows = crawl(spark, sf_dir).withColumn("url", F.when(plain, F.lit("https://plain.example.org/")).otherwise(F.col("url")))
    asked = rows.select("page").distinct().select("page", F.when(F.col("page") % 4 == 1, "timed out").alias("nav_error"), F.lit(None).cast("string").alias("error"))
    return discovery.page_verdict(asked, rows, "page").select("page", "kind", "n_feeds")


@query("SELECT page_id FROM pages WHERE page_id % 10 = 7")
def bad_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = F.when(F.col("page_id") % 10 == 7, F.concat(F.lit("not a page "), F.col("url"))).otherwise(F.col("url"))
    return discovery.bad_targets(pages(spark, sf_dir).select("page_id", wrong.alias("url")), "url").select("page_id")


@query(f"WITH p AS (SELECT page_id, url, {_HOST} AS h FROM pages) SELECT a.page_id, regexp_extract(a.url, '^(https?://[^?#]*)', 1) = regexp_extract(b.url, '^(https?://[^?#]*)', 1) AS same FROM p a JOIN p b ON b.page_id = a.page_id // 2 * 2")
def target_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = pages(spark, sf_dir).select("page_id", "url"), pages(spark, sf_dir).select(F.col("page_id").alias("other"), F.col("url").alias("target"))
    joined = a.join(b, (F.floor(F.col("page_id") / 2) * 2) == F.col("other"))
    return joined.select("page_id", discovery.matches_target(F.col("url"), F.col("target")).alias("same"))


@query(f"WITH {_CRAWL} SELECT n, regexp_matches(mime, '(?i)json|xml|csv|html|text/plain') OR regexp_matches(url, '(?i)bid|cash|price|market|quote|grain|feed') AS keep FROM crawl")
def response_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl(spark, sf_dir).select("n", discovery.looks_like_data(F.col("url"), F.col("mime")).alias("keep"))


@query("SELECT page_id, url FROM pages UNION ALL SELECT page_id, '/api/bids/v' || page_id FROM pages")
def endpoint_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle = F.concat(F.lit('fetch("'), "url", F.lit('");x="/api/bids/v'), F.col("page_id").cast("string"), F.lit('";y="/img/logo.png"'))
    rows = pages(spark, sf_dir).select("page_id", bundle.alias("text"))
    return discovery.endpoints(rows, "page_id", "text").select("page_id", "url")


@query("SELECT page_id, 1 AS calls, 'static/js/a' || page_id || '.js' AS chunks FROM pages")
def bundle_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle = F.concat(F.lit('axios.get("'), "url", F.lit('");import("./static/js/a'), F.col("page_id").cast("string"), F.lit('.js")'))
    return pages(spark, sf_dir).select("page_id", F.size(discovery.call_sites(bundle)).alias("calls"), F.array_join(discovery.chunk_names(bundle), ",").alias("chunks"))


_SITE = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"


@query(
    f"""SELECT page_id, {_SITE} || '/static/a' || page_id % 3 || '.js https://cdn.example.org/x.js' AS scripts,
    regexp_extract(url, '^(https?://[^?#]+/)', 1) || 'frame.html?p=' || page_id || ' ' || split_part(url, ':', 1) || '://ads.example.org/f' AS iframes, {_SITE} || '/main.css' AS links FROM pages"""
)
def page_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id").cast("string")
    marks = F.concat(
        F.lit('<script src="/static/b/../a'), (F.col("page_id") % 3).cast("string"), F.lit('.js"></script><script src="https://cdn.example.org/x.js"></script><script src="https://cdn.example.org/x.js"></script>'),
        F.lit('<iframe src="./frame.html?p='), n, F.lit('"></iframe><iframe src="//ads.example.org/f"></iframe><link rel=x href="/./main.css">'),
    )
    found = pages(spark, sf_dir).select("page_id", discovery.page_assets(marks, F.col("url")).alias("a"))
    return found.select("page_id", *(F.array_join(f"a.{k}", " ").alias(k) for k in ("scripts", "iframes", "links")))


@query(
    f"""WITH {_CRAWL} SELECT n, CASE WHEN contains(url, '.dtn.com/') THEN 'dtn-cs' WHEN contains(url, '.stonex.com/') THEN 'stonehedge' WHEN contains(url, '.barchart.com/') THEN 'barchart' WHEN contains(url, '.bushelops.com/') THEN 'bushel' ELSE '' END AS families FROM crawl"""
)
def vendor_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl(spark, sf_dir).select("n", F.array_join(discovery.family(F.col("url")), ",").alias("families"))


@query(
    f"""WITH {_CRAWL}, k AS (SELECT page, CASE n % 4 WHEN 0 THEN 'dtn-cs' WHEN 1 THEN 'graindesk' END AS lead, CASE n % 4 WHEN 0 THEN 'www.dtn.com' WHEN 1 THEN 'graindiscovery.com' ELSE 'p' || n % 7 || '.example.org' END AS h FROM crawl WHERE page % 3 <> 2)
    SELECT page, 'no-platform' AS kind, coalesce(string_agg(DISTINCT lead, ',' ORDER BY lead), '') AS leads, string_agg(DISTINCT h, ',' ORDER BY h) AS hosts FROM k GROUP BY 1"""
)
def page_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without a known feed name the vendors to which their responses' hosts belong."""
    n = F.col("n") % 4
    plain = F.concat(F.lit("https://p"), (F.col("n") % 7).cast("string"), F.lit(".example.org/"))
    rows = crawl(spark, sf_dir).where("page % 3 <> 2").withColumn("url", F.when(n == 0, "https://www.dtn.com/home").when(n == 1, "https://graindiscovery.com/home").otherwise(plain))
    asked = rows.select("page").distinct().select("page", F.lit(None).cast("string").alias("nav_error"), F.lit(None).cast("string").alias("error"))
    found = discovery.page_verdict(asked, rows, "page")
    return found.select("page", "kind", F.array_join("leads", ",").alias("leads"), F.array_join("hosts", ",").alias("hosts"))


@query(
    """WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'http://localhost:80/' || page_id WHEN 2 THEN 'http://localhost.' || split_part(url, '/', 3) || '/' WHEN 3 THEN replace(url, 'https:', 'http:') ELSE 'http://[::1]/' END AS u FROM pages)
    SELECT page_id, starts_with(u, 'https://') OR page_id % 5 IN (1, 4) AS browsable FROM u"""
)
def browsable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyboard.sources.manifests import browsable

    k, n, site = F.col("page_id") % 5, F.col("page_id").cast("string"), F.split_part("url", F.lit("/"), F.lit(3))
    url = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("http://localhost:80/"), n)).when(k == 2, F.concat(F.lit("http://localhost."), site, F.lit("/"))).when(k == 3, F.replace("url", F.lit("https:"), F.lit("http:"))).otherwise("http://[::1]/")
    return pages(spark, sf_dir).select("page_id", browsable(url).alias("browsable"))
