"""The two queries as batch plans."""
