"""Files, tables, reports and models."""
