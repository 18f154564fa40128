"""DataFrame -> DataFrame operators (joins, aggregates, encoders, ...)."""
