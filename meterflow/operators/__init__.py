"""Operators: pure functions DataFrame(s) -> DataFrame, composed lazily."""
