"""Instruction-data engine on PySpark."""
