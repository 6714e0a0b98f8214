"""Rule-driven table validation and sales KPIs on Spark DataFrames."""
