"""sources of the registry engine."""
