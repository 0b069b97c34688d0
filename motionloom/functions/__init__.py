"""Column expressions without state: clocks, vectors, text and JSON payloads."""
