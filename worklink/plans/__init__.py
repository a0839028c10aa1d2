"""Report tables and the whole run."""
