"""Indicator catalogue, summary tables, change, legend, publishing and metadata."""
