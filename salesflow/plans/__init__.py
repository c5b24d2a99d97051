"""Composite jobs and the mapping of the star schema to sales rows."""
