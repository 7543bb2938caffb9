"""Column functions. Each takes and returns Columns; none needs Python in the row path."""
