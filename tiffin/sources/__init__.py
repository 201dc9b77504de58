"""Landing files, layer tables and control tables."""
