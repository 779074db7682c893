"""Operators: ``DataFrame -> DataFrame`` functions that hold for any table."""
