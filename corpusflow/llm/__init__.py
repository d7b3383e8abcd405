"""Operators for preparing training text: deduplication, decontamination, tokenising,
scoring, scanning, archives and filters. Nothing outside this folder imports it."""
