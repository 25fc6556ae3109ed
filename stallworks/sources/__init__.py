"""Reading daily tables, configuration records and delimited files."""
