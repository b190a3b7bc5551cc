"""DataFrame operators: reshape, enrich, decode, merge, roll up, check."""
