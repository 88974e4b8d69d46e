"""Work on files as they come."""
