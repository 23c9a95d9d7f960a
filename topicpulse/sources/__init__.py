"""Reading feeds and reading and writing the bronze, silver and gold tables."""
