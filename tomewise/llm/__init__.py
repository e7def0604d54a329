"""Operators a training-data pipeline needs: text extraction, quality rules,
deduplication, tokenisation, packing, archives, chat formatting, search.

Each module holds one operator with a general ``DataFrame -> DataFrame``
interface; ``queries.py`` registers one query per operator.  Nothing outside
this package imports it.
"""
