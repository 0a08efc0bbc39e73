"""Household samples and small-area tables from hierarchical population microdata, and operations on text corpora."""
