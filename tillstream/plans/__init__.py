"""Datasets of the order shop: staging, marts, reports, quality, pipeline."""
