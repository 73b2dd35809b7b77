"""Readers of landed files and the warehouse tables."""
