"""DataFrame -> DataFrame operators, each driven by a spec."""
