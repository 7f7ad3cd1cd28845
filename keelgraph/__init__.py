"""Keelgraph: building and maintaining a knowledge graph of text with Spark."""
