"""Readers: topic documents, record files, result tables, driver-side side files."""
