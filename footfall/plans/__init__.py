"""The nine jobs, each a chain of named steps."""
