"""Column helpers: pure expressions, no actions and no Python in the tasks."""
