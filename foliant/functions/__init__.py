"""Column -> Column building blocks; none of them shuffles."""
