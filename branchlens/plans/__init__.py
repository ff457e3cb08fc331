"""Composed jobs: shift fact, reports, ingest, back-fill, attendance."""
