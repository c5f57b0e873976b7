"""Operators for training-data pipelines over `documents`, `pages` and `embeddings`.

One module per operator; ``queries.py`` registers one thin query for each and
``oracles.py`` holds the SQL of those that SQL can express.  Nothing outside
this package (and ``corpus_pipeline.py``) imports it.
"""
