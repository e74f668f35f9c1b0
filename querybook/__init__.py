"""The registered queries: inputs rendered from the driver tables, and their oracle SQL."""
