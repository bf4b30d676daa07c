"""Landing folders followed by a stream."""
