"""lexspark: text search and relevance ranking as Spark jobs.

``build_index`` turns text into postings and statistics tables, ``search`` and
``search_many`` rank documents with BM25, ``tfidf`` weighs terms.
"""

from lexspark.operators.articles import assemble_articles
from lexspark.plans.blocks import build_blocks, read_blocks, search_blocks, search_work
from lexspark.plans.growth import add_documents, compact
from lexspark.plans.indexing import build_index
from lexspark.plans.ranking import all_scores, query_terms, rank_documents, search, search_many
from lexspark.plans.tfidf import tfidf
from lexspark.sources.index_store import (
    SearchIndex,
    drop_old_versions,
    dropped_rows,
    export_text,
    import_text,
    malformed_lines,
    read_index,
)
from lexspark.sources.stopwords import read_stopwords
from lexspark.sources.tables import table_chunks
from lexspark.sources.wiki import read_wiki, untitled_lines, wiki_chunks

__all__ = [
    "SearchIndex",
    "add_documents",
    "all_scores",
    "assemble_articles",
    "build_blocks",
    "build_index",
    "compact",
    "drop_old_versions",
    "dropped_rows",
    "export_text",
    "import_text",
    "malformed_lines",
    "query_terms",
    "rank_documents",
    "read_blocks",
    "read_index",
    "read_stopwords",
    "read_wiki",
    "search",
    "search_blocks",
    "search_many",
    "search_work",
    "table_chunks",
    "tfidf",
    "untitled_lines",
    "wiki_chunks",
]
