"""DataFrame -> DataFrame operators of the mediation, rating, billing and
analytics stages."""
