"""Whole workflows of operators."""
