"""Column expressions: text handling, money arithmetic and validation rules."""
