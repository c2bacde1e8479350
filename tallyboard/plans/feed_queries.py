"""Queries of feeds and of the whole run, over bodies made from suppliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions.text import escape_html
from tallyboard.operators import discovery, generation
from tallyboard.plans import engine
from tallyboard.plans.registry import query, read
from tallyboard.sources import feeds, landing, layouts, manifests, versions
from tallyboard.sources.scratch import new_path, written


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier")


def _bodies(spark: SparkSession, sf_dir: str, body: Column) -> DataFrame:
    k = F.col("s_suppkey")
    return suppliers(spark, sf_dir).select(k.cast("string").alias("source_id"), F.concat(F.lit("https://board.example.com/"), k.cast("string")).alias("url"), body.alias("body"))


def _list_body() -> Column:
    k = F.col("s_suppkey").cast("string")
    head = "<h3 class='c'>YELLOW CORN</h3><ul class=\"fcControlsSubHdr x\"><li>Delivery</li><li>Cash Price</li><li>Basis</li><li>Futures</li><li>Change</li></ul>"
    row = lambda d, cash, basis, fut: F.concat(F.lit(f'<ul class="fcControls1"><li>{d}</li><li>{cash}</li><li>{basis}</li><li>{fut}</li><li>-0-4</li><a href="?CashBidsLocationID='), k, F.lit('"></a></ul>'))
    return F.concat(F.lit("<a href='/cashbidssingle-"), k, F.lit("'>Town "), k, F.lit("</a>"), row("Early", "1", "1", "1"), F.lit(head), row("Oct", "4.24", "-0.35", "459-0s"), row("Nov", "N/A", "--", "459-0"), row("Dec", "$4.30", "(.25)", "455-4"))


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS source_id, n AS seq, CAST(s_suppkey AS VARCHAR) AS location_id, 'Town ' || s_suppkey AS location, 'Yellow Corn' AS commodity, d AS delivery, c::DOUBLE AS cash, b AS basis_cents, f::DOUBLE AS futures_price, g AS futures_flag, -0.5::DOUBLE AS change
    FROM supplier, (VALUES (0, 'Oct', 4.24, -35, 459.0, 's'), (1, 'Dec', 4.30, -25, 455.5, NULL)) v(n, d, c, b, f, g)"""
)
def list_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layouts.list_layout(_bodies(spark, sf_dir, _list_body()))
    return found.select("source_id", "seq", "location_id", "location", "commodity", "delivery", "cash", "basis_cents", "futures_price", "futures_flag", "change")


def _table_body() -> Column:
    k = F.col("s_suppkey")
    head = "<h2>Town</h2><table><tr><td><table><caption>Bids</caption><tr><th>Period</th><th>Cash</th><th>Basis</th><th>Futures Month</th><th>Futures</th></tr>"
    banner = lambda t: f'<tr><td colspan="5">{t}</td></tr>'
    row = lambda d: F.concat(F.lit(f"<tr><td>{d}</td><td>"), (4 + k % 5 * 0.25).cast("string"), F.lit("</td><td>-.5</td><td>Dec 24</td><td>478'6</td></tr>"))
    one = F.concat(F.lit(banner("North")), row("Oct"), F.lit(banner("basis")), row("Nov"))
    return F.concat(F.lit(head), one, F.when(k % 2 == 0, F.concat(F.lit(banner("South")), row("Oct"), row("Oct"))).otherwise(""), F.lit("</table></td></tr></table>"))


@query(
    """WITH r AS (SELECT s_suppkey AS k, n, t, d FROM supplier, (VALUES (0, 'North', 'Oct'), (1, 'North', 'Nov'), (2, 'South', 'Oct')) v(n, t, d) WHERE n < 2 OR s_suppkey % 2 = 0)
    SELECT CAST(k AS VARCHAR) AS source_id, n AS seq, t AS location, t AS commodity, d AS delivery, (4 + (k % 5) * 0.25)::DOUBLE AS cash, -50 AS basis_cents, 'Dec 24' AS futures, 478.75::DOUBLE AS futures_price FROM r"""
)
def table_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layouts.list_and_table(_bodies(spark, sf_dir, _table_body())).bids
    return found.select("source_id", "seq", "location", "commodity", "delivery", "cash", "basis_cents", "futures", "futures_price")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, p AS place, CASE p WHEN 0 THEN 1 ELSE 5 + 3 * (1 - s_suppkey % 2) END AS rows, 'Town' AS heading FROM supplier, (VALUES (0), (1)) v(p)")
def table_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layouts.describe_tables(_bodies(spark, sf_dir, _table_body())).select("source_id", "place", "rows", "heading")


def _fragment_body() -> Column:
    k = F.col("s_suppkey")
    panel = lambda h, c: f"<h1>{h} Bids</h1><table><thead><tr><th>Delivery Date</th><th>Cash-Price</th><th>Basis</th><th>Basis-Month</th><th>Futures-Price</th></tr></thead><tbody><tr><td>Oct</td><td>${c}</td><td>-0.30</td><td>Dec &#039;24</td><td>473'2s</td></tr><tr></tr></tbody></table>"
    tabs = "<button>Corn Bids</button><button>Soybean Bid</button><button>Contact</button>"
    return F.when(k % 3 == 2, "<p>empty</p>").when(k % 3 == 1, tabs + panel("Corn", "4.05") + panel("Red Wing Soybean", "9.99")).otherwise(tabs + panel("Mesa Corn", "4.05") + panel("Dale Corn", "4.10") + panel("Soybean", "9.99"))


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS source_id, n AS seq, 'Red Wing' AS location, c AS commodity, 'Oct' AS delivery, p::DOUBLE AS cash, -30 AS basis_cents, 'Dec ''24' AS futures, 473.25::DOUBLE AS futures_price
    FROM supplier, (VALUES (0, 'Corn', 4.05), (1, 'Soybean', 9.99)) v(n, c, p) WHERE s_suppkey % 3 = 1"""
)
def fragment_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layouts.fragment(_bodies(spark, sf_dir, _fragment_body())).bids
    return found.select("source_id", "seq", "location", "commodity", "delivery", "cash", "basis_cents", "futures", "futures_price")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE s_suppkey % 3 WHEN 2 THEN 'no_panel' ELSE 'no_town' END AS code FROM supplier WHERE s_suppkey % 3 <> 1")
def fragment_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layouts.fragment(_bodies(spark, sf_dir, _fragment_body())).refusals


def _grid_body() -> Column:
    k = F.col("s_suppkey")
    script = F.concat(F.lit("<script>function displayNumber(x, d) { if (x < 5000) x = x - "), (k + 1000).cast("string"), F.lit(" * 2; x = x + (0.5 - .25); document.write(x); }</script><!-- NoScrapeOffset: "), (2 * (k + 1000) - 0.25).cast("string"), F.lit(" -->"))
    broken = F.lit("<script>function displayNumber(x) { x = fetch(1); document.write(x); }</script>")
    cell = lambda v: F.concat(F.lit("<td><script>displayNumber("), (F.lit(v) + 2 * (k + 1000) - 0.25).cast("string"), F.lit(", 2)</script></td>"))
    line = lambda label, *cells: F.concat(F.lit(f'<th scope="row">{label}</th>'), *cells)
    group = F.lit('<tr><th rowspan="4" scope="rowgroup">Thorp</th><th rowspan="4" scope="rowgroup">Corn</th>')
    table = F.concat(
        F.lit('<table class="DataGrid x"><thead><tr ><th scope="col"><span>Oct</span></th><th scope="col"><span>Nov</span></th></tr></thead>'),
        group, line("Cash Price", cell(4.25), cell(4.5)), F.lit("</tr><tr>"), line("Basis", cell(-0.5), cell(-0.25)), F.lit("</tr><tr>"),
        line("Futures Month", F.lit("<td>Dec 24</td><td>Mar 25</td>")), F.lit("</tr><tr>"), line("Futures Price", F.lit("<td><span>475'0s</span></td><td></td>")), F.lit("</tr></table>"),
    )
    return F.concat(F.when(k % 4 == 3, broken).otherwise(script), table)


@query(
    "SELECT CAST(s_suppkey AS VARCHAR) AS source_id, 0 AS seq, 'Thorp' AS location, 'Corn' AS commodity, 'Oct' AS delivery, 4.25::DOUBLE AS cash, -50 AS basis_cents, 'Dec 24' AS futures, 475.0::DOUBLE AS futures_price, 's' AS futures_flag FROM supplier WHERE s_suppkey % 4 <> 3"
)
def grid_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layouts.grid(_bodies(spark, sf_dir, _grid_body())).bids
    return found.select("source_id", "seq", "location", "commodity", "delivery", "cash", "basis_cents", "futures", "futures_price", "futures_flag")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE WHEN s_suppkey % 4 <> 3 THEN (-2 * (s_suppkey + 1000) + 0.25)::DOUBLE END AS \"offset\", CASE WHEN s_suppkey % 4 = 3 THEN 'no_offset' END AS code FROM supplier")
def grid_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layouts.offsets(_bodies(spark, sf_dir, _grid_body()))


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE s_suppkey % 5 WHEN 0 THEN 'not_json' WHEN 1 THEN 'wrong_shape' WHEN 2 THEN 'empty' WHEN 3 THEN 'no_usable_row' ELSE 'unnamed_group' END AS code FROM supplier"""
)
def json_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 5
    body = F.when(k == 0, "<html>").when(k == 1, '{"a":1}').when(k == 2, "[]").when(k == 3, '[{"commodity":{"name":"Corn"},"offers":[{"destination":"x"}]}]').otherwise('[{"offers":[]}]')
    return feeds.grouped_offers(_bodies(spark, sf_dir, body)).refusals


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE WHEN s_suppkey % 2 = 0 THEN 'OBJECT<a: BIGINT, b: ARRAY<STRING>>' END AS shape FROM supplier")
def json_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.shape(_bodies(spark, sf_dir, F.when(F.col("s_suppkey") % 2 == 0, '{"a": 1, "b": ["x"]}').otherwise("12")), "source_id", "body")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, 'T' AS location, 'Corn' AS commodity, 'Nov' AS delivery, 'price pair differs' AS why FROM supplier WHERE s_suppkey % 3 = 0")
def unreconciled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = '{"location":{"id":1,"name":"T"},"commodityDisplayName":"Corn","contractDeliveryLabel":"Nov","cashPrice":4.1,"basisPrice":-0.35,"futuresQuote":"445-0","unitOfMeasure":"bushels","primaryPrice":{"cashPrice":%s}}'
    body = F.when(F.col("s_suppkey") % 3 == 0, f"[{row % '9'}]").otherwise(f"[{row % '4.1'}]")
    return feeds.widget_list(_bodies(spark, sf_dir, body)).unreconciled


# ---------------------------------------------------------------- manifests and the run


def _manifest_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    key = k.cast("string")
    raw = F.concat(
        F.lit('{"id":"'), key, F.lit('","operator":"'), F.col("s_name"), F.lit('","location":"Town '), key, F.lit('","platform":"'), F.when(k % 4 == 1, "dtn-cs").otherwise("graindesk"), F.lit('","url":"https://board.example.com/'), key,
        F.lit('","bands":{"corn":[2,12]},"lat":null,"lon":null,"locationId":'), F.when(k % 6 == 5, '"elsewhere"').otherwise('"T"'), F.when(k % 4 == 1, ',"browserPage":"https://shop.example.com/"').otherwise(""),
        F.when(k % 10 == 9, ',"enabled":false').otherwise(""), F.when(k % 8 == 2, ',"apiKeyEnv":"FEED_KEY"').otherwise(""), F.lit(',"state":"SET THIS","phone":"1"}'),
    )
    return suppliers(spark, sf_dir).select(key.alias("path"), raw.alias("raw"))


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.load(manifests.parse(_manifest_texts(spark, sf_dir)))


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE WHEN s_suppkey % 6 = 5 THEN 'elsewhere' ELSE 'T' END AS location_id, CASE WHEN s_suppkey % 4 = 1 THEN 'dtn-cs/1' ELSE 'graindesk/1' END AS schema, 'json' AS wire, 2 AS urls,
    CASE WHEN s_suppkey % 4 = 1 THEN 'https://shop.example.com/' ELSE '' END AS browser_page FROM supplier WHERE s_suppkey % 10 <> 9"""
)
def source_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = manifests.to_config(loaded(spark, sf_dir))
    return config.select("source_id", "location_id", "schema", "wire", F.size("urls").alias("urls"), "browser_page")


@query("SELECT DISTINCT CASE WHEN s_suppkey % 4 = 1 THEN 'https://shop.example.com/' ELSE '' END AS browser_page, 'https://board.example.com/' || s_suppkey AS url FROM supplier WHERE s_suppkey % 10 <> 9")
def fetch_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.fetch_keys(manifests.to_config(loaded(spark, sf_dir)))


@query("SELECT 'FEED_KEY' AS secret, count(*) AS sources FROM supplier WHERE s_suppkey % 8 = 2")
def missing_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.missing_secrets(loaded(spark, sf_dir), ["OTHER"]).select(F.col("apiKeyEnv").alias("secret"), F.size("ids").cast("long").alias("sources"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, 'state,website,address' AS blanks FROM supplier")
def blank_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.blank_fields(loaded(spark, sf_dir)).select("id", F.array_join("blanks", ",").alias("blanks"))


def _run(spark: SparkSession, sf_dir: str) -> engine.Run:
    k = F.col("s_suppkey")
    offers = '[{"commodity":{"name":"Corn"},"offers":[{"destination":"T","deliveryPeriod":"Oct","standardCashPrice":"4.10","basisPrice":"-0.35","futuresPrice":"445"},{"destination":"U","deliveryPeriod":"Oct","standardCashPrice":"4","basisPrice":"0","futuresPrice":"400"}]},{"commodity":{"name":"Feed Meal"},"offers":[{"destination":"T","deliveryPeriod":"Oct","standardCashPrice":"4.10","basisPrice":"-0.35","futuresPrice":"445"}]}]'
    widget = '[{"location":{"id":"T","name":"Town"},"commodityDisplayName":"Corn","contractDeliveryLabel":"Oct","cashPrice":4.1,"basisPrice":-0.35,"futuresQuote":"%s","unitOfMeasure":"Bushels"}]'
    body = F.when(k % 4 == 1, F.when(k % 3 == 0, widget % "459-0").otherwise(widget % "445-0")).when(k % 7 == 0, "oops").otherwise(offers)
    bodies = _bodies(spark, sf_dir, body).join(suppliers(spark, sf_dir).select(k.cast("string").alias("source_id"), F.when(k % 4 == 1, "dtn-cs").otherwise("graindesk").alias("platform")), "source_id")
    now = F.lit("2024-01-02 12:00:00").cast("timestamp")
    used = ("dtn-cs", "graindesk")
    shown = engine.run(loaded(spark, sf_dir), bodies, _previous(spark, None), now, used).snapshots
    before = shown.where(F.col("source_id").cast("int") % 5 < 3).select("source_id", F.when(F.col("source_id").cast("int") % 5 == 0, "other").otherwise(F.col("bids_hash")).alias("bids_hash"), "count", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("priced_at"), F.when(F.col("source_id").cast("int") % 5 == 1, F.lit("2024-01-02 11:00:00")).otherwise(F.lit("2024-01-02 01:00:00")).cast("timestamp").alias("checked_at"))
    return engine.run(loaded(spark, sf_dir), bodies, written(before), now, used)


def _previous(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows or [], "source_id string, bids_hash string, count long, priced_at timestamp, checked_at timestamp")


_RUN = """WITH s AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 10 <> 9),
c AS (SELECT k, CASE WHEN k % 4 <> 1 AND k % 7 = 0 THEN 'not_json' WHEN k % 6 = 5 THEN 'location_absent' WHEN k % 4 = 1 AND k % 3 = 0 THEN 'identity_unexplained' END AS code FROM s)
"""


@query(
    _RUN
    + """SELECT CAST(k AS VARCHAR) AS source_id, CASE WHEN code IS NULL THEN 'live' ELSE 'refused' END AS health, code, CASE WHEN code IS NULL THEN k % 5 <> 1 END AS write, CASE WHEN code IS NULL THEN k % 5 NOT IN (1, 2) END AS changed,
    CASE WHEN code IS NULL THEN CASE k % 5 WHEN 0 THEN 'price moved' WHEN 1 THEN 'no change' WHEN 2 THEN 'heartbeat' ELSE 'first run' END END AS reason,
    CASE WHEN code IS NULL AND k % 4 <> 1 THEN 1 WHEN code IS NULL THEN 0 END AS withheld FROM c"""
)
def run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: manifests, feeds, guards, decisions and the index."""
    index = _run(spark, sf_dir).index
    held = F.when(F.col("code").isNull(), F.coalesce(F.size("withheld"), F.lit(0)))
    return index.select("source_id", "health", "code", "write", "changed", "reason", F.when(held < 0, F.lit(0)).otherwise(held).alias("withheld"))


@query(_RUN + "SELECT count(*) AS total, count(*) FILTER (code IS NULL) AS live, count(*) FILTER (code IS NOT NULL) AS refused, CAST(0 AS BIGINT) AS broken FROM c")
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engine.counts(_run(spark, sf_dir).index)


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS site, 'site ' || s_suppkey || ', location ' || s_suppkey || '. ' || CASE WHEN s_suppkey % 3 = 0 THEN 'cash rounding floor-cent was read by two runs' WHEN s_suppkey % 3 = 1 THEN 'cash rounding is left open: this run read floor-cent, and there is no earlier run'
    ELSE 'cash rounding is left open: no rule explains every row' END AS note FROM supplier"""
)
def manifest_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = suppliers(spark, sf_dir).select(k.cast("string").alias("site"), k.cast("string").alias("location_id"), F.lit("write").alias("fate"), F.when(k % 3 == 2, "-").otherwise("floor-cent").alias("mode"), (k % 3 == 0).alias("agreed"), F.when(k % 3 == 0, "floor-cent").alias("prior_mode"))
    return generation.note(rows).select("site", "note")


@query("SELECT s_suppkey, 'https://api.example.com/public-sites/Some+%26+' || s_suppkey || '/cash-bids' AS url FROM supplier")
def api_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.concat(F.lit("Some & "), F.col("s_suppkey").cast("string"))
    return suppliers(spark, sf_dir).select("s_suppkey", landing.api_url(F.lit("https://api.example.com//"), token).alias("url"))


@query("SELECT s_suppkey, base64(encode('é ' || s_name)) AS packed, 'é ' || s_name AS text FROM supplier")
def packed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = landing.pack(F.concat(F.lit("é "), F.col("s_name")))
    return suppliers(spark, sf_dir).select("s_suppkey", packed.alias("packed"), landing.unpack(packed).alias("text"))


@query("SELECT s_suppkey, s_suppkey % 2 = 0 AS peek, s_suppkey % 3 <> 1 AS list, s_suppkey % 5 = 0 AS dump FROM supplier")
def look_further(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    none = F.lit(None).cast("array<string>")
    return suppliers(spark, sf_dir).select(
        "s_suppkey",
        discovery.should_peek(F.lit(None).cast("long"), none, F.when(k % 2 == 0, 100).otherwise(5000)).alias("peek"),
        discovery.should_list(k % 3, (k % 3 == 1)).alias("list"),
        discovery.dumpable(F.lit("https://x/GetBidsList"), F.lit(None).cast("string"), F.when(k % 5 == 0, "body"), "bidslist").alias("dump"),
    )


@query("SELECT page_id % 25 AS page, count(*) AS responses, count(DISTINCT regexp_extract(url, '^https?://([^/?#]+)', 1)) AS hosts FROM pages GROUP BY 1")
def site_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "pages").select((F.col("page_id") % 25).alias("page"), "url")
    return landing.survey(rows, "page")


@query("SELECT page_id, len(regexp_extract_all(html, '(?i)<p>')) AS hits FROM pages")
def grep_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "pages")
    return rows.select("page_id", F.size(discovery.grep(F.col("html"), "<p>", 100_000, 0)).cast("long").alias("hits"))


@query("SELECT s_suppkey, '<tr><td>live</td><td>' || s_name || ' &amp; Co</td></tr>' AS line FROM supplier")
def status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = escape_html(F.concat("s_name", F.lit(" & Co")))
    return suppliers(spark, sf_dir).select("s_suppkey", F.concat(F.lit("<tr><td>live</td><td>"), name, F.lit("</td></tr>")).alias("line"))


@query("SELECT page_id, length(html) AS size, 0::BIGINT AS tables, len(regexp_extract_all(html, '(?i)<h1')) AS headings, 0::BIGINT AS rows FROM pages")
def body_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "pages").select("page_id", discovery.body_profile(F.col("html")).alias("p"))
    return found.select("page_id", "p.size", "p.tables", "p.headings", "p.rows")


@query("SELECT s_suppkey, 'x/cash' || s_suppkey || '.js,y/board.js,a' || s_suppkey || '.js' AS chunks FROM supplier")
def ranked_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    names = F.array(F.concat(F.lit("a"), k, F.lit(".js")), F.concat(F.lit("x/cash"), k, F.lit(".js")), F.lit("y/board.js"), F.lit("z.js"))
    return suppliers(spark, sf_dir).select("s_suppkey", F.array_join(discovery.ranked_chunks(names, 3), ",").alias("chunks"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, 'Corn' AS commodity, CAST(s_suppkey AS DOUBLE) / 4 AS cash, CAST(s_suppkey AS INT) AS seq FROM supplier WHERE s_suppkey % 3 = 0")
def first_party_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body of the engine's own shape; what is no JSON, or has no bids, is an empty board."""
    k = F.col("s_suppkey")
    own = F.concat(F.lit('{"bids":[{"seq":'), k.cast("string"), F.lit(',"commodity":"Corn","cash":'), (k.cast("double") / 4).cast("string"), F.lit("}]}"))
    body = F.when(k % 3 == 0, own).when(k % 3 == 1, "oops").otherwise("{}")
    return feeds.first_party(_bodies(spark, sf_dir, body)).bids.select("source_id", "commodity", "cash", "seq")


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS source_id, '(root): object, 3 key(s)|  id = ' || s_suppkey || '|  name = "' || s_name || repeat('-', 28 - length(s_name)) || '…"|.rows[0]: object, ' || (s_suppkey % 60 + 1) || ' key(s)'
    || array_to_string(list_transform(range(least(s_suppkey % 60 + 1, 40)), lambda n: '|  .rows[0].k' || n || ' = ' || n), '') || CASE WHEN s_suppkey % 60 + 1 > 40 THEN '|  … and ' || (s_suppkey % 60 - 39) || ' more key(s)' ELSE '' END AS outline
    FROM supplier WHERE s_suppkey % 4 <> 0"""
)
def json_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyboard.sources.outlines import outline

    k = F.col("s_suppkey")
    row = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), k % 60), lambda n: F.concat(F.lit('"k'), n.cast("string"), F.lit('": '), n.cast("string"))), ", ")
    body = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "name": "'), F.col("s_name"), F.lit("-" * 40 + '", "rows": [{'), row, F.lit("}, 5]}"))
    bodies = _bodies(spark, sf_dir, F.when(k % 8 == 0, "12").when(k % 4 == 0, "no json").otherwise(body))
    return bodies.select("source_id", F.array_join(outline(F.col("body")), "|").alias("outline")).where("outline is not null")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE s_suppkey % 3 WHEN 0 THEN 'present' WHEN 1 THEN 'unreadable' ELSE 'absent' END AS state FROM supplier")
def snapshot_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, folder = suppliers(spark, sf_dir).select(F.col("s_suppkey").cast("string").alias("source_id"), (F.col("s_suppkey") % 3).alias("m")), new_path(spark)
    text = F.when(F.col("m") == 0, '{"bids_hash": "x", "count": 1}').otherwise("oops")
    names.where("m < 2").select("source_id", text.alias("value")).write.partitionBy("source_id").text(folder)
    return landing.snapshot_states(spark, folder, names)


@query(
    _RUN.replace("WHERE s_suppkey % 10 <> 9", "WHERE s_suppkey % 10 <> 9 AND s_suppkey = 3")
    + "SELECT count(*) AS total, count(*) FILTER (code IS NULL) AS live, count(*) FILTER (code IS NOT NULL) AS refused, CAST(0 AS BIGINT) AS broken, count(*) FILTER (code IS NULL) = 0 AS failed FROM c"
)
def run_of_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of one source of many."""
    bodies = _bodies(spark, sf_dir, F.lit('[{"commodity":{"name":"Corn"},"offers":[{"destination":"T","deliveryPeriod":"Oct","standardCashPrice":"4.10","basisPrice":"-0.35","futuresPrice":"445"}]}]')).withColumn("platform", F.lit("graindesk"))
    found = engine.run(loaded(spark, sf_dir), bodies, _previous(spark, None), F.lit("2024-01-02 12:00:00").cast("timestamp"), ("graindesk",), only="3")
    return engine.outcome(found.index)


@query("SELECT 'op' || s_suppkey || '-town' AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'first' ELSE 'second' END AS \"siteId\", false AS enabled FROM supplier")
def manifests_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run writes what the first has not; nothing is overwritten."""
    names, folder = suppliers(spark, sf_dir), new_path(spark)
    none = lambda schema: spark.createDataFrame([], schema)

    def planned(rows, site):
        own = rows.select(F.concat(F.lit("op"), F.col("s_suppkey").cast("string")).alias("operator"), F.lit("Town").alias("location"), F.lit(site).alias("site"), F.col("s_suppkey").cast("string").alias("location_id"), F.lit("-").alias("mode"))
        return generation.note(generation.plan_manifests(own, none("site string, location_id string, mode string"), none("id string, site string, location_id string"), none("town string")))

    generation.write_manifests(planned(names.where("s_suppkey % 2 = 0"), "first"), folder)
    generation.write_manifests(planned(names, "second"), folder)
    return spark.read.schema("id string, siteId string, enabled boolean").json(folder)


@query("SELECT n, CASE n WHEN 1 THEN (SELECT count(*) FROM supplier) ELSE (SELECT count(*) FROM supplier) + 2 END AS rows, n = 2 AS again FROM (VALUES (1), (2)) v(n)")
def versions_after_a_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One writer commits between another's reading and writing; the other decides anew from what is there then."""
    folder, names = new_path(spark), suppliers(spark, sf_dir).select("s_suppkey")
    one = spark.range(1).select(F.lit(-1).cast("long").alias("s_suppkey"))
    first = versions.update(spark, folder, lambda last: names)
    rows = [(1, versions.read(spark, folder, 1).count(), first[1])]
    meanwhile = [lambda last: versions.commit(last.unionAll(one.withColumn("s_suppkey", F.lit(-2).cast("long"))), folder, 1)]

    def decide(last):
        if meanwhile:
            meanwhile.pop()(last)
        return last.unionAll(one)

    number, again = versions.update(spark, folder, decide)
    rows.append((2, versions.read(spark, folder, number).count(), again))
    return spark.createDataFrame(rows, "n int, rows long, again boolean")
