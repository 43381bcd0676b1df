"""Column factories: every function takes and returns Columns, so all of it stays in Catalyst."""
