"""Matching against other catalogues and authority files."""
