"""See the package modules."""
