"""Column expressions shared by plans and operators."""
