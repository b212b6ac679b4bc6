"""Structured Streaming form of the word-count job over a folder that keeps receiving
text files. The reference has no streaming operator; this runs the same batch operator
incrementally and adds none of its own."""
