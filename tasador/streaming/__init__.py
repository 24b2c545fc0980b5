"""Bronze appends driven by a stream of listing files."""
