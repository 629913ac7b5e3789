"""Retail sales analytics as lazy Spark plans."""

from basketry.sources.dataset import Dataset, load_dataset

__all__ = ["Dataset", "load_dataset"]
