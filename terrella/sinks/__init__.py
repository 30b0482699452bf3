"""File writers."""
