"""Column expressions. Every function takes and returns a Column and holds no state."""
