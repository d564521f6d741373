"""From rules to DataFrames."""
