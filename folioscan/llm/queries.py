"""The registered queries of this subpackage and, where SQL can say it, what they must equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from folioscan.llm import (
    decontaminate,
    divergence,
    jaccard,
    mixing,
    packing,
    page_text,
    quality,
    ranked_search,
    secrets,
    simhash,
    substrings,
    token_counts,
)
from folioscan.sources.workspace import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are sources; a repository is a source and a language."""
    documents = _table(spark, sf_dir, "documents")
    repository = F.concat_ws("/", "source", "lang")
    found = secrets.find_secrets(documents, ["doc_id"], F.col("source"), repository)
    return secrets.span_digest(found, ["doc_id"])


OP1_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
  concat_ws('/', source, lang) AS repo FROM documents),
found AS (
  SELECT doc_id, owner, repo, text, 0 AS n, 'assign' AS kind, 8 AS least,
    regexp_extract_all(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS whole,
    regexp_extract_all(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS vals,
    string_split_regex(text, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS gaps
  FROM docs
  UNION ALL
  SELECT doc_id, owner, repo, text, 1, 'access', 16, regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
    regexp_extract_all(text, 'AKIA[A-Z0-9]+'), string_split_regex(text, 'AKIA[A-Z0-9]+') FROM docs
  UNION ALL
  SELECT doc_id, owner, repo, text, 2, 'hex', 32, regexp_extract_all(text, '[0-9a-f]{32,}'),
    regexp_extract_all(text, '[0-9a-f]{32,}'), string_split_regex(text, '[0-9a-f]{32,}') FROM docs),
spans AS (
  SELECT doc_id, owner, repo, n, kind, i, vals[i] AS val,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i-1], lambda x: length(x))), 0) AS s,
    length(whole[i]) AS len
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM found) WHERE length(vals[i]) >= least),
spread AS (SELECT val, count(DISTINCT owner) AS owners FROM spans GROUP BY val),
judged AS (
  SELECT s.*, s + len AS e, CASE WHEN owners >= 3 THEN 'example'
    WHEN owners = 1 AND length(val) >= 16 AND regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]')
      AND len(list_distinct(string_split(val, ''))) >= 8
      AND NOT regexp_matches(val, '(?i)example|sample|dummy|change_?me|placeholder|your[_-]|xxxx|0000|1234567')
    THEN 'live' END AS verdict
  FROM spans s JOIN spread USING (val)),
marks AS (
  SELECT doc_id, s, n, e, kind, true AS base FROM judged
  UNION ALL SELECT doc_id, e - length(val), CASE verdict WHEN 'live' THEN 3 ELSE 4 END, e, verdict, false
  FROM judged WHERE verdict IS NOT NULL)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, n, e), '') AS spans,
  count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (kind = 'example') AS n_example
FROM docs d LEFT JOIN marks m ON d.doc_id = m.doc_id GROUP BY d.doc_id
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return simhash.digest(simhash_rows(_table(spark, sf_dir, "documents"), slots))


def simhash_rows(documents: DataFrame, slots: int) -> DataFrame:
    """A stored row per document with the fingerprints of its text and of its edited text.

    The edited text takes its last half from the beginning of the next document's.
    """
    rows = simhash.with_next_text(documents.select("doc_id", "text"), slots)
    text, following = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    rows = rows.select("slot", "place", "doc_id", text.alias("text"), following.alias("next_text"))
    rows = rows.withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    own, taken = F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring("next_text", F.lit(1), half)
    versions = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")),
    )
    both = rows.withColumn("edited", F.concat(own, taken)).select(
        "slot",
        "place",
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.explode(versions).alias("version"),
    )
    row = ["slot", "place", "doc_id", "n_chars", "edited_sha256"]
    prints = simhash.fingerprints(both.select(*row, "version.which", "version.body"), [*row, "which"], "body")
    of = lambda which, c: F.max(F.when(F.col("which") == which, F.col(c)))
    halves = [of(0, c).alias(c) for c in ("high", "low")] + [of(1, c).alias(f"edited_{c}") for c in ("high", "low")]
    return written(prints.groupBy(*row).agg(*halves), "simhash")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    stats = written(quality.document_statistics(documents, ["doc_id"]), "quality")
    model = quality.fit(quality.labelled(stats, labels))
    scored = quality.score_statistics(stats, model, ["doc_id"])
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP).cast("int").alias("predicted"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM sums),
ordered AS (
  SELECT *, coalesce(sum(3 * source_size) OVER o, 0) AS given, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS open_w,
    sum(source_size) OVER () AS total
  FROM weighed
  WINDOW o AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (
  SELECT (total - given)::DOUBLE / open_w::DOUBLE AS lam FROM ordered
  WHERE (total - given)::DOUBLE / open_w::DOUBLE * w <= 3 * source_size
  ORDER BY 3.0 * source_size / w, source NULLS LAST LIMIT 1),
targets AS (SELECT source, source_size, least(w * lam, (3 * source_size)::DOUBLE) AS target FROM weighed, share),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats FROM targets),
places AS (SELECT source, place, sum(size) AS size FROM sized GROUP BY source, place),
running AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place) AS upto FROM places),
taken AS (
  SELECT r.source, r.place, target, repeats, r.size, upto, target - repeats * source_size AS rest
  FROM running r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size::BIGINT AS size, b.source_size, b.target,
  (d.size * (b.repeats + CASE WHEN t.upto <= t.rest OR
    (t.upto - t.size <= t.rest AND 2 * (t.rest - (t.upto - t.size)) >= t.size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
JOIN taken t ON t.source IS NOT DISTINCT FROM d.source AND t.place = d.place
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT r, unnest(range(1, len(words) - 33)) AS i FROM docs WHERE len(words) >= 35),
windows AS (SELECT s.r, s.i, array_to_string(d.words[s.i:s.i + 34], ' ') AS w FROM starts s JOIN docs d USING (r)),
often AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT r, i + k AS at FROM (SELECT r, i FROM windows SEMI JOIN often USING (w)), range(35) t(k)),
each AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS at FROM docs),
kept AS (
  SELECT e.r, string_agg(word, ' ' ORDER BY e.at) FILTER (c.at IS NULL) AS txt, count(c.at) AS gone
  FROM each e LEFT JOIN covered c ON e.r = c.r AND e.at = c.at GROUP BY e.r)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
  sha256(coalesce(txt, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.r = k.r
"""


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.token_shards(spark, _table(spark, sf_dir, "documents"), sf_dir)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"]
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_table(spark, sf_dir, "documents"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(_table(spark, sf_dir, "pages"), ["page_id", "url"])


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
stats AS (SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS total FROM docs WHERE len(terms) > 0),
items AS (
  SELECT q, item_id, unnest(list_distinct(terms)) AS term FROM (
    SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark)),
hits AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM docs) SEMI JOIN items USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM hits GROUP BY term), stats),
impacts AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total))) AS impact
  FROM hits JOIN weights USING (term), stats),
scores AS (
  SELECT q, item_id, r, doc_id, sum(impact)::BIGINT AS score FROM impacts JOIN items USING (term) GROUP BY ALL HAVING sum(impact) > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores) WHERE rank <= 10
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.differences(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
words AS (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT lang, source, term, coalesce(c, 0) AS c
  FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
of_group AS (
  SELECT *, (1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER g + 5 * count(*) OVER g))::BIGINT AS p
  FROM dense WINDOW g AS (PARTITION BY lang, source)),
of_lang AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER l + 5 * count(*) OVER l))::BIGINT AS q
  FROM (SELECT lang, term, sum(c) AS c FROM dense GROUP BY ALL) WINDOW l AS (PARTITION BY lang)),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source AS one, y.source AS two, sum(abs(x.p - y.p)) AS value
    FROM of_group x JOIN of_group y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
  ON d.lang = a.lang AND d.one = a.source AND d.two = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM of_group JOIN of_lang USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 50
"""


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


LLM_QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_shards": op7_token_shards,
    "op8_token_counts": op8_token_counts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_page_text": op10_page_text,
    "op11_ranked_search": op11_ranked_search,
    "op12_source_divergence": op12_source_divergence,
    "op13_best_fit_packing": op13_best_fit_packing,
    "pipeline": corpus_pipeline.run,
}
LLM_ORACLES = {
    "op1_secret_scan": OP1_SQL,
    "op5_mixing": OP5_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
