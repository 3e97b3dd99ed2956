"""Training-data operators: deduplication, filtering, extraction and token output for text corpora.

Nothing outside this subpackage imports it.  ``skyledger.llm.queries`` registers the thin queries.
"""
