"""Reading source files, writing tables, and their canonical definitions."""
