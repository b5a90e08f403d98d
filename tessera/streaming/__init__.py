"""tessera.streaming."""
