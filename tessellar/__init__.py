"""Tessellar: document datasets on Spark, from article XML to audited splits."""
