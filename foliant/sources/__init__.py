"""Reading file collections and tables, writing results."""
