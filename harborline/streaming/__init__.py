"""The incremental append as a file stream."""
