"""The library's jobs on the driver's tables, and their SQL twins."""
