"""Operators: layer transforms, marts, gates, ingestion and generators."""
