"""Provenance tables at lake scale: run logs and research crates as DataFrames."""
