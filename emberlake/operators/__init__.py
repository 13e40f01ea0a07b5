"""DataFrame to DataFrame steps; no input or output here."""
