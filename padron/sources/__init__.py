"""Sources of the package."""
