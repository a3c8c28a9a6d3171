"""Page extraction, the gate and its counters, languages and vectors over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.catalog import inputs as I
from newsflow.catalog.registry import query
from newsflow.functions import text, urls
from newsflow.operators import gate
from newsflow.operators.embed import embed_texts
from newsflow.operators.language import SLOTS, detect_language, multipliers, train_language_model
from newsflow.operators.neighbour_graph import approximate_neighbours, neighbour_graph
from newsflow.operators.neighbours import nearest_neighbours, with_titles
from newsflow.session import materialise, spread_small


# The character references that the SQL knows; they cover the given pages.
_SQL_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&copy;": "©", "&reg;": "®", "&trade;": "™", "&middot;": "·",
    "&bull;": "•", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—", "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&laquo;": "«", "&raquo;": "»", "&euro;": "€", "&pound;": "£", "&deg;": "°", "&amp;": "&",
}


def _sql_page() -> str:
    """CTEs that give ``page_text(page_id, url, html, title, lang, text)``."""
    body = "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form", "iframe", "svg"):
        body = f"regexp_replace({body}, '(?is)<{tag}(?:\\s[^>]*)?>.*?</{tag}\\s*>', '', 'g')"
    inner = [f"nullif(regexp_extract(body, '(?is)<{t}(?:\\s[^>]*)?>(.*)</{t}\\s*>', 1), '')" for t in ("article", "main", "body")]
    blocks = (
        "address|article|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|h[1-6]|hr|li|main|ol|p|pre|section|table|td|th|tr|ul"
    )
    lines = f"regexp_replace(block, '(?i)</?(?:{blocks})(?:\\s[^>]*)?/?>', chr(10), 'g')"
    plain = f"regexp_replace({lines}, '(?s)<[^>]*>', '', 'g')"

    def named(col: str) -> str:
        for name, value in _SQL_ENTITIES.items():
            col = "replace({}, '{}', '{}')".format(col, name, value.replace("'", "''"))
        return col

    spaced = f"regexp_replace(regexp_replace({named('plain')}, '[ \\t\\r]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
    title = f"trim(regexp_replace({named('''regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)''')}, '[ \\t\\r\\n]+', ' ', 'g'))"
    return f"""bodies AS (SELECT *, {body} AS body FROM pages),
blocks AS (SELECT *, coalesce({', '.join(inner)}, body) AS block FROM bodies),
plains AS (SELECT *, {plain} AS plain FROM blocks),
page_text AS (SELECT page_id, url, html, nullif({title}, '') AS title,
  nullif(lower(regexp_extract(html, '(?is)<html[^>]*\\slang=["'']?([A-Za-z]{{2,3}})', 1)), '') AS lang,
  nullif({I.sql_strip(spaced)}, '') AS text FROM plains)"""


PAGE_TEXT = _sql_page()


def _extracted(spark, d):
    """Pages with accents written as character references, which the SQL side reads as they were."""
    html = F.col("html")
    for letter, name in (("é", "&eacute;"), ("ü", "&uuml;"), ("ñ", "&#241;"), ("ß", "&#xDF;")):
        html = F.replace(html, F.lit(letter), F.lit(name))
    pages = gate.extract_pages(spread_small(I.table(spark, d, "pages")).withColumn("html", html))
    return pages.withColumn("lang", gate.page_lang(F.col("html")))


@query("page_extraction", f"WITH {PAGE_TEXT} SELECT page_id, title, lang, text, author, day FROM (SELECT *, CAST(NULL AS VARCHAR) AS author, CAST(NULL AS VARCHAR) AS day FROM page_text) AS p")
def page_extraction(spark, d):
    return _extracted(spark, d).select("page_id", "title", "lang", "text", "author", F.col("date").alias("day"))


_OUTCOME = """CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN length(text) < 500 THEN 'short_text'
  WHEN lang IS NULL THEN 'lang_error' WHEN lang NOT IN ('en', 'fr') THEN 'lang_filtered_out' ELSE 'kept' END"""


@query("page_gate", f"WITH {PAGE_TEXT} SELECT page_id, {_OUTCOME} AS outcome FROM page_text")
def page_gate(spark, d):
    outcome = gate.gate_outcome(text.is_filled(F.col("text")), F.lit(False), F.col("text"), F.col("lang"), I.LANGS)
    return _extracted(spark, d).select("page_id", outcome.alias("outcome"))


@query(
    "extractor_json_gate",
    """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'empty' WHEN doc_id % 11 = 0 THEN 'json_error' WHEN doc_id % 17 = 0 OR length(text) < 500 THEN 'short_text'
  WHEN doc_id % 13 = 0 THEN 'lang_error' WHEN lang NOT IN ('en', 'fr') THEN 'lang_filtered_out' ELSE 'kept' END AS outcome,
  CAST(CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 17 = 0 THEN -1 ELSE length(text) END AS BIGINT) AS text_chars FROM documents""",
)
def extractor_json_gate(spark, d):
    n = F.col("doc_id")
    full = F.to_json(F.struct(F.lit("t").alias("title"), F.when(n % 17 != 0, F.col("text")).alias("text")))
    docs = I.table(spark, d, "documents").select(
        "doc_id",
        F.when(n % 13 != 0, F.col("lang")).alias("lang"),
        F.when(n % 7 == 0, "").when(n % 11 == 0, F.substring(full, F.lit(1), F.length(full) - 1)).otherwise(full).alias("extracted"),
    )
    gated = gate.gate_json(docs, allowed_langs=I.LANGS)
    known = F.when((n % 11 != 0) & (n % 7 != 0), F.length("text"))
    return gated.select("doc_id", "outcome", F.coalesce(known, F.lit(-1)).cast("bigint").alias("text_chars"))


_STAGED = f"""{PAGE_TEXT},
staged AS (SELECT *, page_id % 4 AS archive, CASE WHEN page_id % 10 = 0 THEN 'other_record' WHEN page_id % 19 = 0 THEN 'no_url'
  WHEN {I.sql_contains_any('url', I.DENIED)} OR NOT {I.sql_contains_any('lower(' + I.sql_netloc('url') + ')', ('example.com', 'example.org'))} THEN 'url_filtered'
  WHEN strlen(html) > 5000 THEN 'too_large' ELSE 'extract' END AS stage FROM page_text),
gated AS (SELECT *, CASE WHEN stage = 'extract' THEN {_OUTCOME} ELSE 'none' END AS outcome FROM staged)"""
_COUNTERS = """count(*) AS records_seen, count(*) FILTER (stage <> 'other_record') AS response_records,
  count(*) FILTER (stage IN ('too_large', 'extract')) AS after_url_filters, count(*) FILTER (stage = 'extract') AS after_size_filter,
  count(*) FILTER (outcome IN ('short_text', 'lang_error', 'lang_filtered_out', 'kept')) AS extract_non_empty,
  count(*) FILTER (outcome = 'json_error') AS json_errors, count(*) FILTER (outcome = 'lang_error') AS lang_errors,
  count(*) FILTER (outcome = 'lang_filtered_out') AS lang_filtered_out, count(*) FILTER (outcome = 'kept') AS written"""


def _gated(spark, d):
    n = F.col("page_id")
    pages = spread_small(I.table(spark, d, "pages")).select(
        "page_id",
        (n % 4).alias("archive"),
        F.when(n % 10 == 0, "request").otherwise("response").alias("rec_type"),
        F.when(n % 19 == 0, F.lit(None)).otherwise(F.col("url")).alias("url"),
        "html",
        F.octet_length("html").alias("payload_bytes"),
    )
    staged = gate.stage_pages(pages, I.DENIED, ("example.com", "example.org"), 5000)
    page = gate.extract_pages(staged.withColumn("html", F.when(F.col("stage") == "extract", F.col("html"))))
    page = page.withColumn("lang", gate.page_lang(F.col("html")))
    outcome = gate.gate_outcome(text.is_filled(F.col("text")), F.lit(False), F.col("text"), F.col("lang"), I.LANGS)
    return page.withColumn("outcome", F.when(F.col("stage") == "extract", outcome))


@query("extraction_counters", f"WITH {_STAGED} SELECT archive, {_COUNTERS} FROM gated GROUP BY archive")
def extraction_counters(spark, d):
    return _gated(spark, d).groupBy("archive").agg(*gate.archive_counters())


@query(
    "folded_counters",
    f"""WITH {_STAGED}, a AS (SELECT archive, {_COUNTERS} FROM gated GROUP BY archive)
SELECT CAST(archive % 2 AS BIGINT) AS month, count(*) AS archives, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in gate.COUNTERS)} FROM a GROUP BY 1""",
)
def folded_counters(spark, d):
    per_archive = _gated(spark, d).groupBy("archive").agg(*gate.archive_counters())
    return gate.fold_counters(per_archive.withColumn("month", F.col("archive") % 2))


_SLOT = "((" + " + ".join(f"unicode(c[i + {k}]) * {m}" for k, m in enumerate(multipliers(3))) + f") % 4294967296) // {(1 << 32) // SLOTS}"
_GRAMS = f"""chars AS (SELECT doc_id, lang, string_split(' ' || array_to_string(string_split_regex(lower(text), '[ \\t\\r\\n]+'), ' ') || ' ', '') AS c FROM documents),
grams AS (SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: {_SLOT})) AS g FROM chars)"""


@query(
    "language_identification",
    f"""WITH {_GRAMS},
counts AS (SELECT lang, g, count(*) AS n FROM grams WHERE doc_id % 2 = 0 GROUP BY lang, g),
tot AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
base AS (SELECT t.lang, ln((SELECT count(*) FROM documents d WHERE d.lang = t.lang AND doc_id % 2 = 0) * 1.0 / (SELECT count(*) FROM documents WHERE doc_id % 2 = 0)) AS prior,
  -ln(total + {SLOTS}) AS unseen FROM tot t),
sizes AS (SELECT doc_id, greatest(len(c) - 2, 0) AS size FROM chars),
hits AS (SELECT x.doc_id, k.lang, sum(ln(k.n + 1.0)) AS s FROM grams x JOIN counts k ON x.g = k.g GROUP BY x.doc_id, k.lang),
scores AS (SELECT z.doc_id, b.lang, prior + size * unseen + coalesce(s, 0) AS score FROM sizes z CROSS JOIN base b LEFT JOIN hits h ON h.doc_id = z.doc_id AND h.lang = b.lang)
SELECT doc_id, lang AS detected_lang FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 6) DESC, lang) AS rn FROM scores) AS r WHERE rn = 1""",
)
def language_identification(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id", "lang", "text")
    model = materialise(train_language_model(docs.where("doc_id % 2 = 0")))
    return detect_language(docs, model)


@query(
    "hashed_embeddings",
    f"""WITH t AS (SELECT doc_id, unnest(string_split_regex(lower({I.sql_strip('text')}), '[ \\t\\r\\n]+')) AS token FROM documents),
b AS (SELECT doc_id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) AS bits FROM t WHERE token <> ''),
s AS (SELECT doc_id, (bits >> 4) % 384 AS place, sum(CASE WHEN bits & 1 = 1 THEN 1 ELSE -1 END) AS n FROM b GROUP BY ALL),
l AS (SELECT doc_id, sqrt(sum(n * n)) AS length FROM s GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS article_id, CAST(place AS INTEGER) AS place, round(CAST(CAST(n / length AS FLOAT) AS DOUBLE), 6) AS value FROM s JOIN l USING (doc_id) WHERE n <> 0""",
)
def hashed_embeddings(spark, d):
    docs = I.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("article_id"), "text")
    vectors = embed_texts(docs).select("article_id", F.posexplode_outer("text_embedding").alias("place", "value"))
    return vectors.where("value <> 0").withColumn("value", F.round(F.col("value").cast("double"), 6))


_NEAREST = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(a.v, b.v), 9) AS s FROM e a JOIN e b ON a.vec_id <> b.vec_id),
nearest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, other) AS rn FROM pairs) AS r WHERE rn = 1)"""


@query("nearest_neighbour", f"WITH {_NEAREST} SELECT vec_id, other AS closest_vec_id, round(s, 6) AS closest_similarity FROM nearest")
def nearest_neighbour(spark, d):
    closest = nearest_neighbours(I.table(spark, d, "embeddings"))
    return closest.withColumn("closest_similarity", F.round("closest_similarity", 6))


@query(
    "closest_article_titles",
    f"""WITH {_NEAREST}, {I.ARTICLES} SELECT n.vec_id AS doc_id, n.other AS closest_doc_id, round(n.s, 6) AS closest_similarity, a.title, b.title AS closest_title
FROM nearest n LEFT JOIN articles a ON a.doc_id = n.vec_id LEFT JOIN articles b ON b.doc_id = n.other""",
)
def closest_article_titles(spark, d):
    vectors = I.table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    closest = with_titles(nearest_neighbours(vectors, "doc_id"), I.articles(spark, d), "doc_id")
    return closest.select(
        "doc_id", "closest_doc_id", F.round("closest_similarity", 6).alias("closest_similarity"), "title", "closest_title"
    )


@query("approximate_neighbours")
def nearest_by_graph(spark, d):
    """Not exact, so without SQL: the tests measure its recall against the exact query."""
    closest = approximate_neighbours(I.table(spark, d, "embeddings"))
    return closest.withColumn("closest_similarity", F.round("closest_similarity", 6))


@query("neighbour_lists")
def neighbour_lists(spark, d):
    """The ten nearest of each vector, by the same graph."""
    graph = neighbour_graph(I.table(spark, d, "embeddings"))
    ranked = graph.select("vec_id", F.posexplode(F.slice("neighbours", 1, 10)).alias("place", "n"))
    return ranked.select("vec_id", (F.col("place") + 1).alias("place"), F.col("n.id").alias("neighbour"), F.round("n.similarity", 6).alias("similarity"))


@query(
    "repeated_links_shards",
    f"""SELECT CAST(CAST('0x' || substr(sha256(sha256({I.sql_domain('url')})), 1, 8) AS BIGINT) % 8 AS BIGINT) AS shard, count(*) AS pages,
  count(DISTINCT {I.sql_domain('url')}) AS hosts FROM pages GROUP BY 1""",
)
def repeated_links_shards(spark, d):
    from newsflow.functions.vectors import shard_of

    pages = I.table(spark, d, "pages").select(urls.domain_from_url(F.col("url")).alias("host"))
    shard = shard_of(text.sha256_hex(F.col("host")), 8)
    return pages.groupBy(shard.alias("shard")).agg(F.count("*").alias("pages"), F.count_distinct("host").alias("hosts"))
