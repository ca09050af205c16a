"""Operators combined: layers of one run, quality checks, publishing, reports, export."""
