"""Skjald: curation and evaluation of speech and text corpora on Spark."""
