"""End-to-end detectors composed of operators. Everything stays lazy."""
