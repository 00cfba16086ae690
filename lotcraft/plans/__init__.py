"""Whole flows: ingest, planning to payload, templates, alerts."""
