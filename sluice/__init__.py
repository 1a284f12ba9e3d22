"""Text, graph, user-table and operation-log jobs over Spark DataFrames."""

from sluice.operators.graph import pagerank, pagerank_top, pagerank_within, paths_of, shortest_paths_to
from sluice.operators.langmodel import language_model, pack_model, suggest
from sluice.operators.lookup import suggest_from, write_lookup_model
from sluice.operators.oplog import kv_latest, kv_read_asof
from sluice.operators.phrases import frequent_ngrams, ngram_counts
from sluice.operators.requests import answer_requests, parse_requests
from sluice.operators.responses import (
    friends_response,
    login_response,
    photo_response,
    suggest_response,
    timeline_response,
)
from sluice.operators.social import friend_list, login, photo_export, photo_lookup, timeline
from sluice.operators.textstats import (
    document_frequency,
    ngrams,
    ngrams_by_key,
    page_tokens,
    term_frequency,
    tfidf,
    tfidf_term,
)
from sluice.operators.upkeep import KeptModel
from sluice.plans.skew import SkewLimits
from sluice.session import build_session, ensure_checkpoint_dir
from sluice.sources.text import parse_graph, parse_pages, read_graph
from sluice.streaming.asof import kv_read_asof_stream, read_answers
from sluice.streaming.requests import (
    compact_latest,
    kv_latest_stream,
    read_latest,
    read_suggestions,
    suggest_stream,
    write_model_table,
)

__all__ = [
    "KeptModel",
    "SkewLimits",
    "answer_requests",
    "build_session",
    "compact_latest",
    "document_frequency",
    "ensure_checkpoint_dir",
    "frequent_ngrams",
    "friend_list",
    "friends_response",
    "kv_latest",
    "kv_latest_stream",
    "kv_read_asof",
    "kv_read_asof_stream",
    "language_model",
    "login",
    "login_response",
    "ngram_counts",
    "ngrams",
    "ngrams_by_key",
    "pack_model",
    "page_tokens",
    "pagerank",
    "pagerank_top",
    "pagerank_within",
    "parse_graph",
    "parse_pages",
    "parse_requests",
    "paths_of",
    "photo_export",
    "photo_lookup",
    "photo_response",
    "read_answers",
    "read_graph",
    "read_latest",
    "read_suggestions",
    "shortest_paths_to",
    "suggest",
    "suggest_from",
    "suggest_response",
    "suggest_stream",
    "term_frequency",
    "tfidf",
    "tfidf_term",
    "timeline",
    "timeline_response",
    "write_lookup_model",
    "write_model_table",
]
