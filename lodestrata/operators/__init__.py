"""Object queries, metrics, versioned tables, warehouse modelling, quality and governance."""
