"""Reading landed pages and stored tables."""
