"""DataFrame-to-DataFrame operators of the trip layers."""
