"""Training-data operators: packing, scans, decontamination, sharding, dedup,
top-k search, PII, web archives and language identification.

Nothing else in the package imports this subpackage.
"""
