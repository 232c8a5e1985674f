"""DataFrame operators: every function takes and returns DataFrames and is
parameterised by column names, so the operators are domain-neutral."""
