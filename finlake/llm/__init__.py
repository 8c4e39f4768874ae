"""Operators for preparing language-model training data.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.  Every
operator takes and returns DataFrames; the driver-facing queries are in
``finlake.llm.queries``.
"""
