"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsflow.llm import licenses, mixing, near_vectors, ngram_join, packing, personal_data, phrases, rules, runs, secret_scan, site_quality, tokens, url_rules
from newsflow.llm.common import WORD, table
from newsflow.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, folder: build(prepare(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op2_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
    return rules.judge(table(spark, folder, "documents")).select(*columns)


_TAKEN_WORDS = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))"


@query(
    "op4_source_mixing",
    f"""
WITH sized AS (
  SELECT doc_id, source, {_TAKEN_WORDS} AS size,
    ('0x' || md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null'))[1:15])::BIGINT AS k
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w,
    row_number() OVER (ORDER BY source IS NULL, source) AS place
  FROM sized GROUP BY source),
summed AS (
  SELECT *, 3 * source_size AS lim, sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w,
    sum(3 * source_size) OVER before_it - 3 * source_size AS lims, sum(w) OVER before_it - w AS ws
  FROM sources WINDOW before_it AS (ORDER BY 3 * source_size / w, place ROWS UNBOUNDED PRECEDING)),
judged AS (SELECT *, lim * (all_w - ws) <= (budget - lims) * w AS stops FROM summed),
targets AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(lim AS DOUBLE) ELSE
    CAST((budget - coalesce(sum(lim) FILTER (stops) OVER (), 0)) * w AS DOUBLE)
      / CAST(all_w - coalesce(sum(w) FILTER (stops) OVER (), 0) AS DOUBLE) END AS target
  FROM judged),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS b,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE
    (b // source_size) * size + greatest(0, least(size, b % source_size - before)) END AS taken
FROM placed""",
)
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query(
    "op7_url_rules",
    rf"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM cut),
rules(h, p, v) AS (VALUES {", ".join(map(str, URL_RULES))}),
fits AS (
  SELECT page_id, host, path, h || p AS rule, v,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) AS n
  FROM parsed LEFT JOIN rules ON ('.' || host) LIKE ('%.' || h) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fits WHERE n = 1""",
)
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, folder, "pages"), rules)


def _listed(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)


def _license_sql() -> str:
    """Sentences as runs of lines between closing marks and blank lines, written without look-around."""
    by_sentence, by_name = licenses._known(licenses.SENTENCES)
    rules = [(name, " ".join(x for part in seq for x in by_name[part])) for name, seq in licenses.RULES]
    most = max(s.count(" ") + 1 + licenses._NAME_WORDS * s.count(licenses.NAME) for s in by_sentence)
    sentence = "run"
    for whole, pattern in licenses._named(by_sentence).items():
        sentence = f"CASE WHEN regexp_matches(run, '{pattern}') THEN '{whole}' ELSE {sentence} END"
    firsts = _listed([(x,) for x in sorted({s.split(" ")[0] for s in by_sentence})])
    return rf"""
WITH known(sentence, id) AS (VALUES {_listed(list(by_sentence.items()))}),
firsts(w) AS (VALUES {firsts}),
rules AS (SELECT row_number() OVER () AS no, license, needed, '% ' || replace(needed, ' ', ' % ') || ' %' AS pat
  FROM (VALUES {_listed(rules)}) t(license, needed)),
kept_dots AS (SELECT doc_id, regexp_replace(regexp_replace(replace(coalesce(text, ''), 'SPDX-License-Identifier:', 'SPDX-License-Identifier '),
  '\b({"|".join(licenses.FIRMS)})\.(\s|$)', '\1 \2', 'g'),
  '(\b[vV])\.(\s[^A-Za-z0-9]{{0,9}}[0-9])', '\1 \2', 'g') AS t FROM documents),
closed AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[.;:!?]+(\s|$)', chr(2) || '\1', 'g'), '(?:\n[^\p{{L}}\p{{N}}\n]*)+\n', chr(2), 'g') AS t FROM kept_dots),
parts AS (SELECT doc_id, unnest(string_split(t, chr(2))) AS part, generate_subscripts(string_split(t, chr(2)), 1) AS pos FROM closed),
lined AS (SELECT doc_id, pos, string_split(trim(regexp_replace(regexp_replace(lower(part), '[^a-z0-9\n]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)), chr(10)) AS lines FROM parts),
begun AS (SELECT doc_id, pos, lines, unnest(range(1, len(lines) + 1)) AS i FROM lined),
runs AS (SELECT doc_id, pos, i, n, array_to_string(lines[i:i + n - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, least({most}, len(lines) - i + 1) + 1)) AS n FROM begun WHERE string_split(lines[i], ' ')[1] IN (SELECT w FROM firsts))),
hits AS (SELECT doc_id, count(*) AS n, '  ' || string_agg(id, '  ' ORDER BY pos, i, r.n) || '  ' AS seq
  FROM (SELECT *, {sentence} AS sentence FROM runs) r JOIN known USING (sentence) GROUP BY doc_id),
matched AS (SELECT doc_id, license, needed, pat, no FROM hits JOIN rules ON seq LIKE pat),
kept AS (SELECT * FROM matched m WHERE NOT EXISTS (SELECT 1 FROM matched o WHERE o.doc_id = m.doc_id
  AND len(string_split(o.needed, ' ')) > len(string_split(m.needed, ' ')) AND ('  ' || replace(o.needed, ' ', '  ') || '  ') LIKE m.pat))
SELECT d.doc_id, coalesce(h.n, 0) AS n_sentences, coalesce(l.names, '') AS licenses
FROM documents d LEFT JOIN hits h USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM kept GROUP BY doc_id) l USING (doc_id)"""


@query("op1_license_scan", _license_sql())
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents"))


@query("op3_personal_data")
def personal_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, folder, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_found")


@query("op8_site_quality")
def site_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Sources stand for sites, and the languages of a source for its paths."""
    judged = site_quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"), F.col("source"), F.col("lang"))
    return judged.drop("_hash")


@query("op6_ngram_join")
def ngram_components(spark: SparkSession, folder: str) -> DataFrame:
    linked = ngram_join.link_documents(table(spark, folder, "documents"), size=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id", "n_links")


@query(
    "op10_near_vectors",
    """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(b) FROM reached WHERE a = vec_id), vec_id)) AS component_id,
  vec_id <= coalesce((SELECT min(b) FROM reached WHERE a = vec_id), vec_id) AS kept
FROM embeddings""",
)
def near_vector_components(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.link_vectors(table(spark, folder, "embeddings"))


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all documents; in one document of ten the words from a place on repeat with a period first."""
    docs = table(spark, folder, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"), F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10").alias("g"))
    placed = chosen.withColumn("a", F.expr("int(CASE WHEN size(w) > 0 THEN g % size(w) END)")).withColumn("p", F.expr("int(1 + (size(w) - a) div (3 + g % 8))"))
    repeated = F.expr("concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), int(1 + (size(w) - a) div p))), 1, size(w) - a))")
    texts = placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
    found = runs.find_runs(texts)
    longer = lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x)
    listed = F.transform("runs", lambda x: F.concat_ws(",", *(x[c].cast("string") for c in ("start", "length", "period"))))
    best = found.withColumn("best", F.reduce("runs", F.get("runs", F.lit(0)), longer))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op11_phrase_mining",
    r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS MATERIALIZED (
  SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase, count(*) AS f
  FROM places, (VALUES (1), (2), (3)) sizes(s) WHERE i + s - 1 <= len(w) GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE s = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, s, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE s > 1 AND f >= 10),
halves AS (
  SELECT c.*, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM candidates c, (VALUES (1), (2)) t(k) WHERE k < s),
parts AS (SELECT lang, phrase, f FROM grams WHERE f >= 10),
cuts AS (
  SELECT h.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM halves h JOIN parts x ON x.lang = h.lang AND x.phrase = lp JOIN parts y ON y.lang = h.lang AND y.phrase = rp),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (1), (2)) t(i) WHERE s = 3 GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
  FROM scored JOIN total USING (lang) LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT * FROM ranked WHERE rank <= 2000""",
)
def phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.top_collocations(table(spark, folder, "documents"))


@query("op12_secret_scan")
def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_found")
