"""Metadata-driven ingestion and change detection as composable PySpark operators."""

from tidemark.model import CheckpointSpec, ObjectSpec, Run

__all__ = ["CheckpointSpec", "ObjectSpec", "Run"]
