"""Audited period totals from periodic, semi-structured measurement reports."""
