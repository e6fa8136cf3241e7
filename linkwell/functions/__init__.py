"""Column functions: no DataFrame, no job, usable in any select."""
