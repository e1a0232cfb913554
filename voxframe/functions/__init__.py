"""Functions: Column helpers and small Arrow UDFs."""
