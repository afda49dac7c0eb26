"""Streaming data quality and star schema for traffic sensor events, on PySpark.

Layers: raw messages -> bronze (parsed text) -> silver (typed, clipped, validated,
enriched) plus quarantine -> gold (seven dimensions, two facts).
"""
