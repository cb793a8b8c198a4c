"""Reading and publishing tables, and session settings."""
