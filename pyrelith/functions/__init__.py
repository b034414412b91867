"""See the README for the layout of this package."""
