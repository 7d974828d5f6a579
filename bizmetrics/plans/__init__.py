"""The four reports, each a function from source tables to a lazy DataFrame."""
