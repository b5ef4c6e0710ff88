"""Training-data operators: dedup, tokenization, quality, language, decontamination, archives, licences.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
