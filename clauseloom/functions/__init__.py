"""Column functions. They take and return Columns and never touch a DataFrame."""
