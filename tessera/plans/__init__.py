"""User-level jobs assembled from operators, and their bindings to the driver tables."""
