"""Operators for preparing large language-model training data.

Each module holds one operator with its own general interface; ``queries``
binds them to the test tables and ``oracle`` holds the DuckDB twins.  Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
