"""Whole runs composed of operators, and the posts they run on in queries."""
