"""Whole jobs, the fixture tables they are tested on, and the query catalogue."""
