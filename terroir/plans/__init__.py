"""Whole products composed from the operators, each one lazy plan."""
