"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it; its queries live in
:mod:`tidemark.llm.queries` and its oracle SQL in :mod:`tidemark.llm.oracles`.
"""
