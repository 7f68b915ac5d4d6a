"""Operators of a training-data pipeline: packing, PII, decontamination,
substring dedup, language-model scoring, fingerprints, secret scans,
toxicity, n-gram joins and binary token output.

Nothing else in the library imports this subpackage.
"""
