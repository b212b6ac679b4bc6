"""Readers for the reference's inputs, inputs derived from the driver tables, and sinks."""
