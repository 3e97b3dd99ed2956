"""Column functions: units, states, statistics, meteorology."""
