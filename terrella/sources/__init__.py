"""File readers and reproducible generators."""
