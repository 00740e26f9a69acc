"""Plans of the package."""
