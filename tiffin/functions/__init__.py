"""Column functions: cleaning, metrics, text and vectors."""
