"""Spark-native curation, judging and routing of teacher-labelled text."""

__version__ = "0.1.0"
