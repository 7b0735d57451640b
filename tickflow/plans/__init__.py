"""Report queries and the registry of checked queries."""
