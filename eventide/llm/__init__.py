"""Operators of a training-data pipeline: search, packing, token files,
deduplication, licence scans, tokenizing, web archives and language ID.

Nothing else in the library imports this subpackage.  ``queries`` registers
one ``opN_<name>`` query per operator.
"""
