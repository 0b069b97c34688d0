"""Reading stored tables and source exports, and writing tables."""
