"""Reading tables, deriving series, and writing results."""
