"""Distributed CSV writers for centroids, elbow curves, labelled points and
geocoded points."""
