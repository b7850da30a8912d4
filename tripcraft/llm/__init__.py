"""Operators of a training-data pipeline: near-dedup, token counts, extraction, decontamination, binary
output, personal data, mixing, quality, embedding dedup, language identification, packing, Merkle manifests
and centroid clustering.

Nothing else in the library imports this subpackage.
"""
