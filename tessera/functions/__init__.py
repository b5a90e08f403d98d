"""tessera.functions."""
