"""Column functions for posting fields. They never raise on bad input, whatever the ANSI setting."""
