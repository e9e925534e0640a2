"""Operators for preparing training corpora: deduplication, scoring, mixing and cleaning.

Nothing outside this subpackage imports it. Every operator takes and returns DataFrames and keeps a
general interface; the thin registered queries live in :mod:`textloom.llm.queries`.
"""
