"""DataFrame-in, DataFrame-out operators over element and feature tables."""
