"""Scans, CRM-shaped views, snapshot tables and sinks."""
