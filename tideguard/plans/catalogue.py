"""All registered queries and, where SQL can express them, their oracles."""

from __future__ import annotations

from tideguard.plans import model_queries, report_queries, stream_queries, text_queries

_MODULES = (report_queries, text_queries, stream_queries, model_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: text for module in _MODULES for name, text in module.ORACLES.items()}

# The report written as CSV and read back must equal the report itself.
ORACLES["report_csv_roundtrip"] = ORACLES["category_breakdown"]
