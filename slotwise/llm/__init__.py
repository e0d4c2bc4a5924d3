"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface;
:mod:`slotwise.llm.queries` registers one query per operator. Nothing outside
this folder imports it, apart from ``__spark_entry__.py`` and
``corpus_pipeline.py``.
"""
