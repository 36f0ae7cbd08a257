"""Operators of a training-data pipeline: deduplication, scans, search, classifiers, decontamination and mixing."""
