"""Readers and writers of what the stages exchange."""
