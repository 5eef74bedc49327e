"""Operators for training-data pipelines: scoring, filtering, deduplication, formats.

Nothing outside this folder imports it. ``queries`` holds the registered queries
and their SQL counterparts.
"""
