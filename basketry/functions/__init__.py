"""Column-level building blocks: everything here returns a Column or adds columns."""
