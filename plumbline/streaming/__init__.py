"""The landing step as a stream."""
