"""The registered queries of the training-data operators, one `opN_<name>` for each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import decontaminate, html_text, line_dedup, lm_score, packing, quality_rules, secret_scan, sharding, simhash_dedup, substring_dedup, suffix_dedup, token_alignment, vector_codes
from tallyboard.sources.scratch import written


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _listed(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(kind) for kind in secret_scan.BASE_KINDS),
        F.sha2(_listed(F.filter("spans", lambda s: s.kind.isin(*secret_scan.BASE_KINDS))), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_common_lines(docs).select(
        "doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 of the map has 40 shards; version 2 is its edit for 41, whose shard is given as next_shard."""
    records = sharding.slotted(read(spark, sf_dir, "documents"))
    size = sharding.slot_bytes(records)
    first = sharding.first_map(size, 40)
    slot_map = written(sharding.map_table(spark, [first, sharding.rebalance(first, size, 41)]))
    placed = sharding.moved(sharding.assign(records, slot_map, 1), slot_map, 2, "next_shard")
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = lm_score.score(docs, lm_score.fit(docs))
    return scored.withColumn("per_token", F.col("log_prob") / F.nullif(F.col("n_tokens"), F.lit(0)))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    books = vector_codes.fit(vectors)
    coded = vector_codes.encode(vectors, books)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


#: The folder of the public vocabularies.
TOKENIZERS = "/opt/tokenizers"


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = token_alignment.files(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    found = token_alignment.align(read(spark, sf_dir, "documents"), vocabularies)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_html_text": op7_html_text,
    "op8_sharding": op8_sharding,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_lm_score": op10_lm_score,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_alignment": op12_token_alignment,
    "op13_suffix_dedup": op13_suffix_dedup,
    "pipeline": pipeline,
}

_WHITE = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP6_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id < c.last, false) AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS s FROM words WHERE len(ws) >= 50)),
first AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, s + d AS pos
  FROM (SELECT doc_id, s, unnest(generate_series(0, 49)) AS d FROM windows JOIN first USING (k) WHERE doc_id > least)),
each AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM words),
judged AS (
  SELECT e.doc_id, e.pos, e.word, g.pos IS NOT NULL AS lost FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos)
SELECT d.doc_id, count(j.pos) AS n_words, count(j.pos) FILTER (j.lost) AS n_removed,
       sha256(coalesce(string_agg(j.word, ' ' ORDER BY j.pos) FILTER (NOT j.lost), '')) AS kept_sha256
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id
"""

_ALNUM = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

OP3_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS ws FROM benchmark),
wanted AS (
  SELECT DISTINCT item, n, array_to_string(ws[s:s + n - 1], ' ') AS k
  FROM (SELECT item, ws, least(13, len(ws)) AS n, unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) AS s FROM items WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM wanted),
words AS (SELECT doc_id, {_ALNUM} AS ws FROM documents),
there AS (
  SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS s FROM words, lengths WHERE len(ws) >= n)),
found AS (SELECT t.doc_id, t.n, t.s, w.item FROM there t JOIN wanted w ON t.k = w.k AND t.n = w.n),
hits AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, s + unnest(generate_series(0, n - 1)) AS pos FROM (SELECT DISTINCT doc_id, n, s FROM found)) GROUP BY doc_id),
held AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(w.ws) AS contaminated
FROM words w LEFT JOIN hits h ON w.doc_id = h.doc_id LEFT JOIN held i ON w.doc_id = i.doc_id
"""

#: Kind, what stands before the part that counts, that part, its least characters.
_SECRETS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["\']?\x20*[:=]\x20*["\']?""", "[A-Za-z0-9+/_.=-]+", 8),
    ("access", "", "AKIA[A-Z0-9]+", 16),
    ("hex", "", "[0-9a-f]+", 32),
    ("key_block", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    ("signed_token", "", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 1),
    ("forge_token", "", "gh[oprsu]_[A-Za-z0-9]{36,}", 1),
    ("chat_token", "", "xox[abprs]-[A-Za-z0-9-]{10,}", 1),
    ("url_login", "", r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/:@]+:[^\x00-\x20/:@]+@", 1),
)


def _marked_sql(place: int, kind: str, before: str, counts: str, least: int) -> str:
    """Matches, put between characters 2 and 4 with 3 before what counts; a match's place is the length of all before it."""
    expression = f"({before})({counts})".replace("'", "''")
    marked = rf"regexp_replace(coalesce(text, ''), '{expression}', chr(2) || '\1' || chr(3) || '\2' || chr(4), 'g')"
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, {least} AS least, {marked} AS marked FROM documents"""


#: Texts without characters 2 to 4, which mark the matches.
OP2_SQL = f"""
WITH marked AS ({" UNION ALL ".join(_marked_sql(k, *s) for k, s in enumerate(_SECRETS))}),
parts AS (
  SELECT doc_id, place, kind, least, unnest(string_split(marked, chr(2))) AS part, generate_subscripts(string_split(marked, chr(2)), 1) AS n FROM marked),
placed AS (
  SELECT *, coalesce(sum(length(part) - 2 * (n > 1)::INT) OVER (PARTITION BY doc_id, place ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM parts),
found AS (
  SELECT doc_id, place, kind, start::BIGINT AS start, (start + strpos(part, chr(4)) - 2)::BIGINT AS stop
  FROM placed WHERE n > 1 AND strpos(part, chr(4)) - strpos(part, chr(3)) - 1 >= least),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed l ON d.doc_id = l.doc_id
"""


def _near_sql(name: str, book: str) -> str:
    """Each part's nearest entry; squared distance and index share one number, so ties go to the lower index."""
    return f"""
{name} AS (
  SELECT p.vec_id, p.p, any_value(p.x) AS x, min(((p.x[1] - c.c[1]) ** 2 + (p.x[2] - c.c[2]) ** 2 + (p.x[3] - c.c[3]) ** 2 + (p.x[4] - c.c[4]) ** 2)::BIGINT * 64 + c.e) AS best
  FROM parts p JOIN {book} c ON p.p = c.p GROUP BY p.vec_id, p.p)"""


def _moved_sql(name: str, near: str, book: str) -> str:
    means = ", ".join(f"floor(sum(x[{j}])::DECIMAL(38, 0) / count(*))::BIGINT" for j in range(1, 5))
    return f"""
{name} AS (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c
  FROM {book} b LEFT JOIN (SELECT p, best % 64 AS e, [{means}] AS c FROM {near} GROUP BY p, best % 64) m ON b.p = m.p AND b.e = m.e)"""


#: Vectors of 64 components, of which each part has four.
OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, p, v[4 * p + 1:4 * p + 4] AS x FROM (SELECT *, unnest(range(16)) AS p FROM kept)),
book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts QUALIFY e < 64),
{_near_sql("near0", "book0")},
{_moved_sql("book1", "near0", "book0")},
{_near_sql("near1", "book1")},
{_moved_sql("book2", "near1", "book1")},
{_near_sql("near2", "book2")},
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(best % 64)), 2, '0'), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM near2 GROUP BY vec_id),
labelled AS (SELECT c.*, k.label FROM coded c JOIN kept k ON c.vec_id = k.vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM labelled
"""

#: Over the characters of each byte's hexadecimal digits, so that a place is a byte.
OP13_SQL = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (
  SELECT doc_id, s, md5(substr(x, 2 * s + 1, 100)) AS k
  FROM (SELECT doc_id, x, unnest(range(len(x) // 2 - 49)) AS s FROM bytes WHERE len(x) >= 100)),
first AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k HAVING count(DISTINCT doc_id) > 1),
late AS (SELECT DISTINCT doc_id, s FROM windows JOIN first USING (k) WHERE doc_id > least),
apart AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS fresh FROM late),
numbered AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM apart),
spans AS (SELECT doc_id, span, min(s) AS low, max(s) + 50 AS high FROM numbered GROUP BY doc_id, span),
between_ AS (
  SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS past FROM spans),
removed AS (
  SELECT b.doc_id, sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS last,
         string_agg(substr(x, 2 * past + 1, 2 * (low - past)), '' ORDER BY low) AS kept
  FROM between_ b JOIN bytes d ON b.doc_id = d.doc_id GROUP BY b.doc_id)
SELECT d.doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes d LEFT JOIN removed r ON d.doc_id = r.doc_id
"""

ORACLE: dict[str, str] = {"op13_suffix_dedup": OP13_SQL, "op11_vector_codes": OP11_SQL, "op1_substring_dedup": OP1_SQL, "op2_secret_scan": OP2_SQL, "op3_decontaminate": OP3_SQL, "op6_line_dedup": OP6_SQL}
