"""DataFrame operators: each takes DataFrames and returns DataFrames or small fitted state."""
