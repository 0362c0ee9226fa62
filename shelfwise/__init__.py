"""Supplier and inventory analytics as Spark DataFrame operators."""
