"""DataFrame to DataFrame operators over episodes."""
