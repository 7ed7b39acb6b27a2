"""The registered queries of this folder, over whole tables, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import (
    chat,
    decontamination,
    divergence,
    fill_middle,
    minhash,
    neighbours,
    prefix_counts,
    repeats,
    surrogates,
    token_file,
    toxicity,
    word_bpe,
    wrappers,
)
from lexspark.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SURROGATE_KEY = "lexspark"
TOKEN_LIMIT = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def toxicity_net(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Net:
    """A net fitted to the labelled documents that are not held out."""
    return toxicity.fit(docs, _table(spark, sf_dir, "labels").filter(~held_out()))


def op1_nearest_neighbours(spark, sf_dir):
    index, coder = neighbours.build_index(_table(spark, sf_dir, "embeddings"), k=5)
    return neighbours.nearest(index, coder, index.filter("vec_id % 50 = 0"), k=5)


def op2_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2, similarity=(4, 5))


def op3_benchmark_leaks(spark, sf_dir):
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_token_file(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    token_file.write_tokens(_table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return token_file.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_repeated_passages(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return repeats.remove_repeats(docs, kinds=repeats.ALL_KINDS, line_words=repeats.MIN_WORDS)


def op6_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_net(spark, docs, sf_dir))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged"
    )


def op7_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    path = scratch_path(spark, "chat")
    chat.write_formatted(chat.format_conversations(turns), path)
    return chat.digests(chat.read_formatted(spark.read.parquet(path)))


def op8_surrogates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY)


def op9_word_bpe(spark, sf_dir):
    return word_bpe.digests(word_bpe.round_trip(_table(spark, sf_dir, "documents"), WORD_BPE))


def op10_token_counts(spark, sf_dir):
    counts = prefix_counts.token_counts(_table(spark, sf_dir, "documents"), PIECE_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_fill_middle(spark, sf_dir):
    formed = fill_middle.fill_middle(_table(spark, sf_dir, "documents"))
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return formed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_main_text(spark, sf_dir):
    extracted = wrappers.extract(_table(spark, sf_dir, "pages"))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))


def op13_source_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_nearest_neighbours,
            op2_near_duplicates,
            op3_benchmark_leaks,
            op4_token_file,
            op5_repeated_passages,
            op6_toxicity,
            op7_chat_format,
            op8_surrogates,
            op9_word_bpe,
            op10_token_counts,
            op11_fill_middle,
            op12_main_text,
            op13_source_divergence,
        )
    }


_NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
smallest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN smallest ON a = doc_id"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, chr(92), ''))
    + {places}
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 ELSE 7 END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  regexp_matches(string_agg(left(role, 1), '' ORDER BY turn, role, text), '^s?(ua)+$') AS valid
FROM sized GROUP BY conv_id"""

_FILL_MIDDLE = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h
  FROM documents),
numbers AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
    text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 AS plain,
    CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 AS spm
  FROM hashed),
parts AS (
  SELECT *, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    least(a, b) AS i, greatest(a, b) AS j, text[1:least(a, b)] AS prefix,
    text[least(a, b) + 1:greatest(a, b)] AS middle, text[greatest(a, b) + 1:] AS suffix
  FROM numbers)
SELECT doc_id, n, form, CASE WHEN NOT plain THEN i END AS prefix_chars, CASE WHEN NOT plain THEN j - i END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""

_MAIN_TEXT = r"""
WITH articles AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS inner_html FROM pages),
blocks AS (
  SELECT page_id, url, list_transform(
    regexp_split_to_array(regexp_replace(inner_html, '\s+', ' ', 'g'), '</?(?:h1|p)>'),
    lambda b: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '<br>', ' ', 'g'),
      '</?b>', '', 'g'), ' +', ' ', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'))) AS found
  FROM articles)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM (
  SELECT page_id, url, array_to_string(list_filter(found, lambda b: b <> ''), chr(10)) AS text FROM blocks)"""

_DIVERGENCE = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM docs) GROUP BY ALL HAVING count(*) >= 10),
sources AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT lang, source, term, count(*) AS n
  FROM (SELECT lang, source, unnest(words) AS term FROM docs) JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, sum(n) OVER (PARTITION BY lang, source) AS total,
    sum(n) OVER (PARTITION BY lang) AS lang_total, sum(n) OVER (PARTITION BY lang, term) AS lang_n,
    (SELECT count(*) FROM kept k WHERE k.lang = sources.lang) AS vocabulary
  FROM sources JOIN kept USING (lang) LEFT JOIN cells USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n,
    1 + CAST(1000000000 * (n + 2) AS HUGEINT) // CAST(coalesce(total, 0) + 2 * vocabulary AS HUGEINT) AS p,
    1 + CAST(1000000000 * (lang_n + 2) AS HUGEINT) // CAST(lang_total + 2 * vocabulary AS HUGEINT) AS q
  FROM dense),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (
  SELECT s.lang, s.source, t.source AS item, coalesce(value, 0) AS value
  FROM sources s JOIN sources t ON s.lang = t.lang AND s.source <> t.source
  LEFT JOIN pairs ON pairs.lang = s.lang AND pairs.source = s.source AND pairs.item = t.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM every_pair
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10"""


def oracle_sql() -> dict[str, str]:
    marks = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|", "|>"]
    places = " + ".join(f"(length(text) - length(replace(text, '{m}', ''))) // {len(m)}" for m in marks)
    return {
        "op2_near_duplicates": _NEAR_DUPLICATES,
        "op7_chat_format": _CHAT.format(places=places),
        "op11_fill_middle": _FILL_MIDDLE,
        "op12_main_text": _MAIN_TEXT,
        "op13_source_divergence": _DIVERGENCE,
    }
