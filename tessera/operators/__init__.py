"""DataFrame -> DataFrame operators (cleaning, encoding, scaling, clustering,
evaluation, tiles, projection)."""
