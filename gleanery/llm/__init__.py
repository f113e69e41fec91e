"""Operators of a training-data pipeline: scoring, deduplication, extraction, packing, scans and filters of documents and pages."""
