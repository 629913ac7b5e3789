"""Complete analyses and the registry of named queries."""
