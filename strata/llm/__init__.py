"""Operators of a training-data pipeline: packing, deduplication, tokenizing,
chat formatting, token counts, vector search, quality rules and WARC archives.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` at the
repository top chains five of the operators.
"""
