"""File sources and run parameters."""
