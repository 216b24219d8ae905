"""Whole jobs: from triples to a lake on disk."""
