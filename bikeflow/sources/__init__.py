"""Feed documents, trip archives, GeoJSON and the bindings to the driver's tables."""
