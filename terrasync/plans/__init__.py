"""Configuration, table contracts and jobs."""
