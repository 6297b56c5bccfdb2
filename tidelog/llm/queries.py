"""Registered queries of the training-data operators and their SQL."""

from tidelog.llm import (  # noqa: F401  (register their queries)
    chat_format,
    conversation_repair,
    decontamination,
    fingerprints,
    language_id,
    line_dedup,
    merkle,
    ngram_join,
    packing,
    secret_scan,
    substring_dedup,
    token_files,
    url_rules,
)
from tidelog.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
