"""Routes from named inputs to targets, and the reports."""
