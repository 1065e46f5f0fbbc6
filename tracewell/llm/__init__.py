"""Training-data operators: near-duplicates, extraction, packing, tokenisation, filtering and media columns.

Nothing outside this folder (but for ``corpus_pipeline.py`` and the guarded import in ``__spark_entry__.py``) imports it.
"""
