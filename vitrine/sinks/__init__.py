"""Landing files, streaming tables and rewritten views."""
