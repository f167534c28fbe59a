"""Column expressions: parsing, geography, money, display formats."""
