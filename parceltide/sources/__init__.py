"""Readers for CSV sources, stored feature tables and file manifests."""
