"""Jobs: compositions of the operators over stored tables."""
