"""Operators of a training-data pipeline: packing, language ID, chat, deduplication,
decontamination, search, sharding, license scans and mixing.

Nothing else in the library imports this package; ``queries`` registers one
query per operator.
"""
