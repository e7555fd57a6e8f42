"""Operators for preparing large training corpora.

Each module holds one operator with its general interface; ``queries.py``
registers the thin queries over the test tables. Nothing outside this
subpackage imports it, apart from the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
