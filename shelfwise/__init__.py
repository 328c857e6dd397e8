"""Catalog reconciliation and enrichment as PySpark DataFrame operators."""
