"""Composite plans: staging, marts, tiles, ingest, quality, the full build run."""
