"""DataFrame operators. Each takes frames plus column names and small configuration."""
