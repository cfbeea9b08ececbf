"""Incremental refresh and streaming variants."""
