"""Operators of a large-scale training-data pipeline.

Nothing outside this folder (and ``corpus_pipeline.py``, which counts as part
of it) imports it; the rest of the library works without it.
"""
