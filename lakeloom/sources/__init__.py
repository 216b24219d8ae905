"""Where triples and tables come from, and where lake tables go."""
