"""Test suites and the layered pipeline built from the operators."""
