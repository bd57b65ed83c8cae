"""Corpus preparation operators: scans, filters, deduplication, decontamination, packing.

Nothing outside this subpackage imports it.
"""
