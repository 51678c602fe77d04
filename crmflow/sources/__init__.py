"""Reading raw files, and reading and writing the tables of the layers."""
