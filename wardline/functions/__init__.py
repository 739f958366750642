"""Column expressions: time axis, scalar functions, recoding and decision rules."""
