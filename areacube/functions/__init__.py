"""Column-level helpers (STR*, DAT*, MTH3, CND*) and the F-distribution tail."""
