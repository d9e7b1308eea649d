"""Report plans and the registered fixture queries."""
