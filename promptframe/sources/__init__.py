"""Readers: documents, request and answer lines, ground truth, step tables."""
