"""The registered queries: how the operators run on the driver tables."""
