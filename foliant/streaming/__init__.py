"""Restartable work on files as they arrive."""
