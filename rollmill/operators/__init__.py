"""DataFrame-to-DataFrame operators: select, truncate, aggregate, balance."""
