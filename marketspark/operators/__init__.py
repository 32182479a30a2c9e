"""Trade transformations: each takes and returns DataFrames and works on batch and stream unless it says otherwise."""
