"""Scans: driver tables, raw trip sources, manifests, file inventories, JSONL records."""
