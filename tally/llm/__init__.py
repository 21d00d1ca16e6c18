"""Training-data operators: packing, filters, scans, classifiers and deduplication.

Nothing outside this subpackage imports it.
"""
