"""Column expressions: casts, lineage, validation rules."""
