"""DataFrame -> DataFrame steps: decode, views, latest state, reconcile, capture, apply."""
