"""Readers: vendor files, stored tables and the projection of the test tables."""
