"""Operators of a training-data pipeline: toxicity, token counts, licence scans, near-duplicate
joins, URL filters, line and substring deduplication, tokenisation, nearest neighbours and
benchmark decontamination. Nothing else in the package imports this subpackage."""
