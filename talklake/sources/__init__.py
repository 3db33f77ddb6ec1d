"""Landing tables, the store, rendered files and result formats."""
