"""Operators of a training-data pipeline: scoring, near-duplicates, decontamination, archives,
formatting, sharding, mixing and filtering of documents. Nothing else in the library imports this."""
