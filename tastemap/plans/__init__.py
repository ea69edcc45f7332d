"""Plans: pipeline and the registry of checked queries."""
