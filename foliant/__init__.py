"""Foliant: text and document analytics as Spark DataFrame operators."""
