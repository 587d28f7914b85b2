"""Whole runs: the layout pipeline, its command line, and the registered queries."""
