"""functions of the registry engine."""
