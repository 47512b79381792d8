"""Column functions. Every function takes and returns Columns and stays in codegen."""
