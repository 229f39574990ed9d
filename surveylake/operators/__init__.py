"""Relational operators: month replacement, upsert, change detection,
unions, counts and nested-document decoding."""

from .audit import counts_by_source, dedup, observed, total_rows
from .merge import (change_predicate, changed_pairs, changed_rows, distinct_months, drop_months, keep_months,
                    key_condition, month_key, month_replace, update_months, upsert_by_key)
from .nested import (DocumentLayout, conform_to_schema, decode_documents, explode_prefixed,
                     flatten_struct, parse_documents, row_id)
from .union import union_all, union_sources

__all__ = [n for n in dir() if not n.startswith("_")]
