"""Operators on whole tables: dedup, audit, rights, export, coverage, crawl decisions, reports."""
