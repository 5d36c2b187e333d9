"""Reading and writing tables, reports and models."""
