"""The queries of this subpackage and their SQL statements."""

from __future__ import annotations

from . import (decontaminate, jaccard_join, language_id, license_scan, line_dedup, nearest, periodic_runs, sentencepiece_codec, spelling, substring_dedup,
               token_counts, toxicity, url_filter)

_MODULES = (toxicity, token_counts, license_scan, jaccard_join, line_dedup, url_filter, substring_dedup, sentencepiece_codec, nearest, decontaminate,
            language_id, periodic_runs, spelling)

QUERIES = {name: job for m in _MODULES for name, job in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
