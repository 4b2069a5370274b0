"""New review files as a stream."""
