"""Reading and writing tables and rule files."""
