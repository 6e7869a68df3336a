"""Reading source tables and files, writing loads, and the state that makes loads incremental."""
