"""Operators for preparing training text: extraction, scoring, filtering, mixing.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
