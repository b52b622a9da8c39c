"""Evaluation tables: regression errors, curves, confusion counts, reports."""
