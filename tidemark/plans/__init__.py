"""Reports, business metrics and whole-pipeline rebuilds."""
