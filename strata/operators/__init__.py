"""Relational operators: sampling, lifecycle, rules, enrichment, reports."""
