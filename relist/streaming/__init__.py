"""The same jobs over a stream of landed pages."""
