"""Positional text index, boolean / phrase / pattern search and TF-IDF ranking on Spark."""

from termloom.functions.text import normalize_tokens
from termloom.operators.indexing import SearchIndex, build_index
from termloom.operators.maintenance import ingest_report, upsert
from termloom.operators.matching import match_leaves, match_patterns, match_phrases, match_terms
from termloom.plans.query_log import parse_query_log, query_status, scoring_terms
from termloom.plans.search import leaf_counts, ranked_search, score_matches, search
from termloom.sources.corpus import read_text_files
from termloom.sources.index_store import load_index, save_index

__all__ = [
    "SearchIndex",
    "build_index",
    "ingest_report",
    "leaf_counts",
    "load_index",
    "match_leaves",
    "match_patterns",
    "match_phrases",
    "match_terms",
    "normalize_tokens",
    "parse_query_log",
    "query_status",
    "ranked_search",
    "read_text_files",
    "save_index",
    "score_matches",
    "scoring_terms",
    "search",
    "upsert",
]
