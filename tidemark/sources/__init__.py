"""Reading and typing of JSON and CSV logs."""
