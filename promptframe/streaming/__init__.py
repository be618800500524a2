"""The row-by-row steps on file streams."""
