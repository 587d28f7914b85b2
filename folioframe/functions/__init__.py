"""Column functions of the layout contract."""
