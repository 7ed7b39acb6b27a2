"""The registered queries as SQL, for the side-by-side check on DuckDB.

Each statement is a chain of common table expressions over ``documents`` and ``benchmark``.
"""

from __future__ import annotations

QUERY = "the worthless thenti onen"
RAW_QUERY = "The Worthless, thenti onen, the"

# Spark's English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()

# ---------------------------------------------------------------- cleaning

_SPLIT = r"string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"
_TRIM = r"regexp_replace(raw, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
_NO_HEADING = rf"regexp_replace({_TRIM}, '={{2}}.*={{2}}', '', 'g')"
_FOREIGN = r"[^A-Za-z0-9\[\]]"

_LINES = f"""
raw_lines AS (
  SELECT doc_id AS doc, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS line_no
  FROM (SELECT doc_id, {_SPLIT} AS parts FROM documents)),
norm_lines AS (
  SELECT doc, line_no, replace(regexp_replace({_NO_HEADING}, ' +', ' ', 'g'), '-', ' ') AS line FROM raw_lines),
lines AS (
  SELECT doc, line_no, rtrim(lower(replace(regexp_replace(line, '{_FOREIGN}', ' ', 'g'), ']]', '')), ' ') AS chunk
  FROM norm_lines WHERE line <> '')"""

_LINES_ASCII_FIRST = f"""
raw_lines AS (
  SELECT doc_id AS doc, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS line_no
  FROM (SELECT doc_id, {_SPLIT} AS parts FROM documents)),
norm_lines AS (
  SELECT doc, line_no, regexp_replace({_NO_HEADING}, '{_FOREIGN}', ' ', 'g') AS line FROM raw_lines),
lines AS (
  SELECT doc, line_no, rtrim(lower(replace(regexp_replace(line, ' +', ' ', 'g'), ']]', '')), ' ') AS chunk
  FROM norm_lines WHERE line <> '')"""

_TOKENS = """
tokens AS (
  SELECT doc, term FROM (SELECT doc, unnest(string_split(chunk, ' ')) AS term FROM lines) WHERE term <> '')"""

_COUNTS = "counts AS (SELECT doc, term, count(*) AS tf FROM tokens GROUP BY doc, term)"

_STATS = """
lengths AS (SELECT doc, CAST(sum(tf) AS BIGINT) AS dl FROM counts GROUP BY doc),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(dl) AS BIGINT) AS total_len, avg(dl) AS avg_len FROM lengths),
idf AS (
  SELECT term, df, log10((n_docs - df + 0.5) / (df + 0.5)) AS idf
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), corpus)"""

_TERM_SCORES = """
term_scores AS (
  SELECT q.query_id, c.doc, c.term, 2.5 * c.tf * i.idf / (c.tf + 0.375 + 1.125 * l.dl / avg_len) AS score
  FROM query_terms q JOIN idf i USING (term) JOIN counts c USING (term) JOIN lengths l USING (doc), corpus),
scores AS (SELECT query_id, doc, sum(score) AS score FROM term_scores GROUP BY query_id, doc)"""


def _query(*terms: str) -> str:
    values = ", ".join(f"(0, '{term}')" for term in terms)
    return f"query_terms(query_id, term) AS (SELECT * FROM (VALUES {values}))"


_INDEX = ",".join([_LINES, _TOKENS, _COUNTS, _STATS])
_TOP10 = "SELECT doc, round(score, 6) AS score FROM scores ORDER BY round(scores.score, 9) DESC, doc LIMIT 10"
_ALL = """
all_scores AS (
  SELECT l.doc, coalesce(s.score, 0.0) AS score FROM lengths l LEFT JOIN scores s ON s.doc = l.doc)"""

_BENCHMARK_TERMS = f"""
query_terms AS (
  SELECT DISTINCT query_id, term FROM (
    SELECT item_id AS query_id, unnest(string_split(lower(replace(regexp_replace(regexp_replace(
      text, '={{2}}.*={{2}}', '', 'g'), '{_FOREIGN}', ' ', 'g'), ']]', '')), ' ')) AS term
    FROM benchmark)
  WHERE term <> '')"""

# ---------------------------------------------------------------- stemming

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_GT0, _GT1 = f"^(?:{_C})?{_V}{_C}", f"^(?:{_C})?{_V}{_C}{_V}{_C}"
_EQ1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
_VOWEL = f"^(?:{_C})?[aeiouy]"
_CVC = f"^{_C}[aeiouy][^aeiouwxy]$"

# The suffix rules of the published algorithm.
_DOUBLE = """ational ate, tional tion, enci ence, anci ance, izer ize, bli ble, alli al, entli ent, eli e,
ousli ous, ization ize, ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous, aliti al,
iviti ive, biliti ble, logi log"""
_DERIVED = "icate ic, ative, alize al, iciti ic, ical ic, ful, ness"
_RESIDUAL = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _swap(source: str, name: str, rules: str) -> str:
    pairs = [(rule.split() + [""])[:2] for rule in rules.split(",")]
    suffixes = "|".join(old for old, _ in pairs)
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in pairs)
    return f"""
{name}_suffix AS (SELECT term, w, regexp_extract(w, '({suffixes})$', 1) AS suffix FROM {source}),
{name} AS (
  SELECT term, CASE WHEN suffix <> '' AND regexp_matches(left(w, length(w) - length(suffix)), '{_GT0}')
    THEN left(w, length(w) - length(suffix)) || CASE suffix {cases} END ELSE w END AS w
  FROM {name}_suffix)"""


def _stems(source: str) -> str:
    return f"""
st_y AS (SELECT DISTINCT term, regexp_replace(term, '^y', 'Y') AS w FROM {source}),
st_plural AS (
  SELECT term, CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN left(w, length(w) - 2)
    WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN left(w, length(w) - 1) ELSE w END AS w
  FROM st_y),
st_cut AS (
  SELECT term, w, CASE WHEN w LIKE '%eed' THEN ''
    ELSE regexp_extract(w, '^((?:{_C})?[aeiouy].*)(?:ed|ing)$', 1) END AS cut
  FROM st_plural),
st_past AS (
  SELECT term, CASE
    WHEN w LIKE '%eed' THEN CASE WHEN regexp_matches(left(w, length(w) - 3), '{_GT0}') THEN left(w, length(w) - 1) ELSE w END
    WHEN cut = '' THEN w
    WHEN regexp_matches(cut, '(?:at|bl|iz)$') THEN cut || 'e'
    WHEN length(cut) > 1 AND right(cut, 1) = left(right(cut, 2), 1) AND regexp_matches(cut, '[^aeiouylsz]$')
      THEN left(cut, length(cut) - 1)
    WHEN regexp_matches(cut, '[aeiou]y(?:yy)+$|[^aeiouy](?:yy)+$') THEN left(cut, length(cut) - 1)
    WHEN regexp_matches(cut, '{_CVC}') THEN cut || 'e' ELSE cut END AS w
  FROM st_cut),
st_final_y AS (
  SELECT term, CASE WHEN w LIKE '%y' AND regexp_matches(left(w, length(w) - 1), '{_VOWEL}')
    THEN left(w, length(w) - 1) || 'i' ELSE w END AS w
  FROM st_past),{_swap("st_final_y", "st_double", _DOUBLE)},{_swap("st_double", "st_derived", _DERIVED)},
st_residual_suffix AS (
  SELECT term, w, regexp_extract(w, '({_RESIDUAL.replace(" ", "|")})$', 1) AS suffix FROM st_derived),
st_residual AS (
  SELECT term, CASE WHEN suffix <> '' AND regexp_matches(left(w, length(w) - length(suffix)), '{_GT1}')
      AND (suffix <> 'ion' OR regexp_matches(left(w, length(w) - 3), '[st]$'))
    THEN left(w, length(w) - length(suffix)) ELSE w END AS w
  FROM st_residual_suffix),
st_final_e AS (
  SELECT term, CASE WHEN w LIKE '%e' AND (regexp_matches(left(w, length(w) - 1), '{_GT1}')
      OR (regexp_matches(left(w, length(w) - 1), '{_EQ1}') AND NOT regexp_matches(left(w, length(w) - 1), '{_CVC}')))
    THEN left(w, length(w) - 1) ELSE w END AS w
  FROM st_residual),
st_final_l AS (
  SELECT term, CASE WHEN w LIKE '%ll' AND regexp_matches(w, '{_GT1}') THEN left(w, length(w) - 1) ELSE w END AS w
  FROM st_final_e),
stems AS (
  SELECT term, CASE WHEN length(term) < 3 THEN term ELSE regexp_replace(w, '^Y', 'y') END AS stem FROM st_final_l)"""


_STEMMED_COUNTS = """
raw_counts AS (SELECT doc, term, count(*) AS tf FROM tokens GROUP BY doc, term),
counts AS (
  SELECT doc, stem AS term, CAST(sum(tf) AS BIGINT) AS tf FROM raw_counts JOIN stems USING (term) GROUP BY doc, stem)"""
_STEMMED_INDEX = ",".join([_LINES, _TOKENS, _stems("tokens"), _STEMMED_COUNTS, _STATS])
# stems of the query
_STEMMED_QUERY = "query_terms(query_id, term) AS (SELECT * FROM (VALUES (0, 'the'), (0, 'worthless'), (0, 'thenti'), (0, 'onen')))"

# ---------------------------------------------------------------- stop words, TF-IDF

_STOP = "stopwords(word) AS (SELECT * FROM (VALUES {}))".format(
    ", ".join("('{}')".format(word.replace("'", "''")) for word in STOP_WORDS)
)
_KEPT = "kept AS (SELECT * FROM counts WHERE term NOT IN (SELECT word FROM stopwords))"
_KEPT_DF = """
n AS (SELECT count(DISTINCT doc) AS n_docs FROM counts),
dfs AS (SELECT term, count(*) AS df FROM kept GROUP BY term)"""
_TFIDF = ",".join([_LINES, _TOKENS, _COUNTS, _STOP, _KEPT, _KEPT_DF])

# ---------------------------------------------------------------- wiki text

_WIKI = r"""
chunks AS (
  SELECT '[[Doc ' || l.doc || ']]' AS doc, l.line_no, l.chunk
  FROM lines l JOIN norm_lines n USING (doc, line_no) WHERE NOT regexp_matches(n.line, '^\[{2}.*\]{2}'))"""
_WIKI_TOKENS = """
tokens AS (
  SELECT doc, term FROM (SELECT doc, unnest(string_split(chunk, ' ')) AS term FROM chunks) WHERE term <> ''),
title_tokens AS (
  SELECT doc, unnest(string_split(doc, ' ')) AS term FROM (SELECT DISTINCT doc FROM chunks))"""
_WIKI_COUNTS = """
body_counts AS (
  SELECT doc, stem AS term, count(*) AS tf FROM tokens JOIN stems USING (term) GROUP BY doc, stem),
counts AS (
  SELECT doc, term, CAST(sum(tf) AS BIGINT) AS tf
  FROM (SELECT * FROM body_counts UNION ALL SELECT doc, term, 1 FROM title_tokens) GROUP BY doc, term)"""
_WIKI_INDEX = ",".join([_LINES, _WIKI, _WIKI_TOKENS, _stems("tokens"), _WIKI_COUNTS])
_BODY = """
SELECT doc, CAST(0 AS BIGINT) AS segment,
  coalesce(string_agg(chunk, ' ' ORDER BY line_no) FILTER (WHERE line_no >= first_line), '') AS body
FROM (SELECT *, min(CASE WHEN chunk <> '' THEN line_no END) OVER (PARTITION BY doc) AS first_line FROM {})
GROUP BY doc"""
_STEM_LINES = """
stemmed_chunks AS (
  SELECT doc, line_no, string_agg(coalesce(stem, ''), ' ' ORDER BY pos) AS chunk
  FROM (SELECT doc, line_no, unnest(string_split(chunk, ' ')) AS term,
          generate_subscripts(string_split(chunk, ' '), 1) AS pos FROM chunks)
  LEFT JOIN stems USING (term) GROUP BY doc, line_no)"""


_MERGED = f"""
odd AS (SELECT doc_id, 'x]] y ==z== w-' || doc_id || chr(10) || text AS text FROM documents WHERE text IS NOT NULL),
{_LINES.replace("FROM documents", "FROM odd").lstrip()},
bodies AS (
  SELECT doc, chunk FROM lines JOIN norm_lines USING (doc, line_no)
  WHERE NOT regexp_matches(norm_lines.line, '^\\[{{2}}.*\\]{{2}}'))"""


_PER_QUERY = """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc) AS rank FROM scores)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc, round(score, 6) AS score FROM ranked WHERE rank <= {}"""
_COMMON_WORDS = """
query_terms(query_id, term) AS (
  SELECT CAST(query_id AS BIGINT), unnest(string_split(words, ' '))
  FROM (VALUES (0, 'the of'), (1, 'the'), (2, 'of and the onen'), (3, 'worthless the'), (4, 'and of in the to')) q(query_id, words))"""


def oracle_sql() -> dict[str, str]:
    counts = f"WITH {_LINES},{_TOKENS},{_COUNTS}"
    index = f"WITH {_INDEX}"
    ranked = f"WITH {_INDEX},{_query(*QUERY.split())},{_TERM_SCORES}"
    weights = f"WITH {_TFIDF}"
    per_query = f"WITH {_INDEX},{_BENCHMARK_TERMS},{_TERM_SCORES}{_PER_QUERY.format(10)}"
    return {
        "clean_lines": f"WITH {_LINES} SELECT doc, CAST(line_no AS INTEGER) AS line_no, chunk FROM lines",
        "clean_lines_ascii_first": f"WITH {_LINES_ASCII_FIRST} "
        "SELECT doc, CAST(line_no AS INTEGER) AS line_no, chunk FROM lines",
        "tokens_per_doc": f"WITH {_LINES},{_TOKENS} "
        "SELECT doc, count(*) AS n_tokens, count(DISTINCT term) AS n_terms FROM tokens GROUP BY doc",
        "postings": f"{counts} SELECT doc, term, tf FROM counts",
        "doc_length": f"WITH {_LINES},{_TOKENS} SELECT doc, count(*) AS dl FROM tokens GROUP BY doc",
        "corpus_stats": f"{index} SELECT n_docs, total_len, round(avg_len, 6) AS avg_len FROM corpus",
        "document_frequency": f"WITH {_LINES},{_TOKENS} "
        "SELECT term, count(DISTINCT doc) AS df FROM tokens GROUP BY term",
        "bm25_idf": f"{index} SELECT term, df, round(idf, 6) AS idf FROM idf",
        "length_coefficient": f"{index} "
        "SELECT doc, dl, round(0.375 + 1.125 * dl / avg_len, 6) AS k FROM lengths, corpus",
        "query_terms": f"WITH {_BENCHMARK_TERMS} SELECT query_id, term FROM query_terms",
        "bm25_term_scores": f"{ranked} SELECT doc, term, round(score, 6) AS score FROM term_scores",
        "bm25_all_scores": f"{ranked},{_ALL} SELECT doc, round(score, 6) AS score FROM all_scores",
        "bm25_sorted": f"{ranked},{_ALL} SELECT doc, round(score, 6) AS score FROM all_scores "
        "ORDER BY round(all_scores.score, 9) DESC, doc",
        "bm25_top10": f"{ranked} {_TOP10}",
        "bm25_top10_all": f"WITH {_INDEX},{_query('the', 'of')},{_TERM_SCORES},{_ALL} "
        "SELECT doc, round(score, 6) AS score FROM all_scores ORDER BY round(all_scores.score, 9) DESC, doc LIMIT 10",
        "bm25_top10_raw_query": f"WITH {_INDEX},{_query('the', 'worthless,', 'thenti', 'onen,')},{_TERM_SCORES} {_TOP10}",
        "bm25_topk_per_query": per_query,
        "bm25_ranked": f"{ranked},{_ALL} SELECT doc, round(score, 6) AS score, "
        "row_number() OVER (ORDER BY round(score, 9) DESC, doc) AS rank FROM all_scores",
        "bm25_topk_blocks": per_query,
        "bm25_topk_blocks_negative": f"WITH {_INDEX},{_COMMON_WORDS},{_TERM_SCORES}{_PER_QUERY.format(25)}",
        "bm25_blocks_work": f"WITH {_LINES},{_TOKENS},{_COUNTS},{_BENCHMARK_TERMS} "
        "SELECT query_id, count(*) AS n_matched, true AS no_more_scored FROM query_terms JOIN counts USING (term) GROUP BY query_id",
        "grown_index_top10": f"{ranked} {_TOP10}",
        "grown_index_postings": f"{index} SELECT doc, term, tf, dl FROM counts JOIN lengths USING (doc)",
        "grown_index_terms": f"{index} SELECT term, df, round(idf, 6) AS idf FROM idf",
        "compacted_index_topk": per_query,
        "index_roundtrip_top10": f"{ranked} {_TOP10}",
        "text_roundtrip_top10": f"{ranked} {_TOP10}",
        "text_roundtrip_postings": f"{counts} SELECT 'd-' || doc || chr(9) || chr(92) || 't' || chr(10) || chr(92) AS doc, "
        "term, tf FROM counts",
        "text_malformed_lines": "SELECT CASE doc_id % 3 WHEN 1 THEN 'a-' || doc_id ELSE '-x' || chr(9) || '1' END AS value, "
        "count(*) AS n_lines FROM documents WHERE doc_id % 3 > 0 GROUP BY 1",
        "stopword_tokens": f"{weights} SELECT doc, term, tf FROM kept",
        "stopword_file_tokens": f"{counts},{_BENCHMARK_TERMS} "
        "SELECT doc, term, tf FROM counts WHERE term NOT IN (SELECT term FROM query_terms)",
        "tf_log": f"{weights} SELECT doc, term, round(1 + log10(tf), 6) AS log_tf FROM kept",
        "tfidf_idf": f"{weights} SELECT term, df, round(log10(1 + n_docs // df), 6) AS idf FROM dfs, n",
        "tfidf": f"{weights} SELECT term, doc, tf, df, round((1 + log10(tf)) * log10(1 + n_docs // df), 6) AS tfidf "
        "FROM kept JOIN dfs USING (term), n",
        "tfidf_exact": f"{weights} SELECT term, doc, tf, df, round((1 + log10(tf)) * log10(1 + n_docs / df), 6) AS tfidf "
        "FROM kept JOIN dfs USING (term), n",
        "stem_vocabulary": f"WITH {_LINES},{_TOKENS},{_stems('tokens')} SELECT term, stem FROM stems",
        "postings_stemmed": f"WITH {_LINES},{_TOKENS},{_stems('tokens')},{_STEMMED_COUNTS} "
        "SELECT doc, term, tf FROM counts",
        "bm25_top10_stemmed": f"WITH {_STEMMED_INDEX},{_STEMMED_QUERY},{_TERM_SCORES} {_TOP10}",
        "wiki_title_carry": f"WITH {_LINES},{_WIKI} SELECT doc, chunk FROM chunks",
        "wiki_title_carry_bzip2": f"WITH {_LINES},{_WIKI} SELECT doc, chunk FROM chunks",
        "wiki_articles": f"WITH {_LINES},{_WIKI}{_BODY.format('chunks')}",
        "wiki_articles_stemmed": f"WITH {_LINES},{_WIKI},{_WIKI_TOKENS},{_stems('tokens')},{_STEM_LINES}"
        f"{_BODY.format('stemmed_chunks')}",
        "wiki_articles_segments": f"SELECT doc, body FROM (WITH {_LINES},{_WIKI}{_BODY.format('chunks')})",
        "wiki_postings": f"WITH {_WIKI_INDEX} SELECT doc, term, tf FROM counts",
        "wiki_bm25_top10": f"WITH {_WIKI_INDEX},{_STATS},{_STEMMED_QUERY},{_TERM_SCORES} {_TOP10}",
        "wiki_tfidf": f"""WITH {_LINES_ASCII_FIRST},{_WIKI},{_WIKI_TOKENS},{_STOP},
counts AS (SELECT doc, term, count(*) AS tf FROM tokens GROUP BY doc, term),
kept AS (
  SELECT doc, term, CAST(sum(tf) AS BIGINT) AS tf FROM (
    SELECT * FROM counts WHERE term NOT IN (SELECT word FROM stopwords)
    UNION ALL SELECT doc, term, 1 FROM title_tokens)
  GROUP BY doc, term),{_KEPT_DF}
SELECT term, doc, tf, df, round((1 + log10(tf)) * log10(1 + n_docs // df), 6) AS tfidf
FROM kept JOIN dfs USING (term), n""",
        "wiki_merged_postings": f"""WITH {_MERGED}
SELECT doc, term, count(*) AS tf FROM (
  SELECT '[[Doc ' || doc % 300 || ']]' AS doc, unnest(string_split(chunk, ' ')) AS term FROM bodies WHERE doc % 5 > 0
  UNION ALL
  SELECT '[[Doc ' || doc_id % 300 || ']]', unnest(['[[Doc', doc_id % 300 || ']]', 'part', doc_id || ''])
  FROM odd WHERE doc_id % 5 > 0)
WHERE term <> '' GROUP BY doc, term""",
        "dropped_while_building": f"WITH {_MERGED} SELECT 'untitled_lines' AS kind, count(*) AS n FROM bodies WHERE doc % 5 = 0 "
        "UNION ALL SELECT 'malformed_lines', count(*) FROM documents WHERE doc_id % 3 > 0",
        "wiki_untitled_lines": f"WITH {_MERGED} SELECT count(*) AS n_lines FROM bodies WHERE doc % 5 = 0",
    }
