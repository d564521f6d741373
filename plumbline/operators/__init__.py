"""One module per physical family of checks; each returns a lazy verdict DataFrame."""
