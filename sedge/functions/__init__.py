"""Part of sedge."""
