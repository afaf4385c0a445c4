"""Training-data operators: deduplication, filters, mixing, tokenisation and fingerprints.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
