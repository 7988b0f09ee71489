"""Reading and writing tables, records, fitted state and models."""
