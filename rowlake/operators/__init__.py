"""Routing, profiling, shaping, schema evolution and evidence."""
