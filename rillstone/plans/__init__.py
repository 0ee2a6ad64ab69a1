"""plans of the registry engine."""
