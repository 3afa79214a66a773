"""The operators as queries over the shared test tables, with their SQL oracles."""
