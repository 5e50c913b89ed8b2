"""Jobs over a stored lake, and reports in their display order."""
