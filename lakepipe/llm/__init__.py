"""Operators for preparing language-model training text.

One module per operator; ``queries`` registers one query per operator. Nothing
outside this folder and ``corpus_pipeline.py`` imports it.
"""
