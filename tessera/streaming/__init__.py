"""Streaming use of the batch operators.

The reference has no streaming. The assignment, scaling, weekday encoding,
tile and projection operators are stateless column expressions, so they run
unchanged on a ``readStream`` DataFrame; this package only packages the
common case (score arriving records against a fitted clustering)."""
