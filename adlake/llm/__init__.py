"""Operators for preparing training data: deduplication, filters, classifiers, mixing and packing.

Nothing outside this folder imports it. Each operator has a module of its own with a general interface; ``queries`` holds
the thin registered queries and their SQL.
"""
