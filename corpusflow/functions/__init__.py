"""Column functions: text, PII finders/maskers, Markdown rendering."""
