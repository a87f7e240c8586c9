"""File events and the file-arrival stream."""
