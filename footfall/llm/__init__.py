"""Operators of a training-data pipeline over tables of documents, vectors and files.

Each module holds one operator with its general interface; ``queries`` applies them to the given
tables. Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
