"""Operators for preparing training text: scoring, duplicates, packing, scans and decontamination.

Nothing else in the library imports this package. Every operator takes DataFrames whose
documents have at least ``doc_id`` (integer) and ``text`` (string); other columns are ignored
unless an operator says that it passes them on.
"""
