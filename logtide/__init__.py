"""Batch, streaming and retrieval jobs for on-chain event logs, written for Spark."""
