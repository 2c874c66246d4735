"""End-to-end jobs and the bindings to the driver tables."""
