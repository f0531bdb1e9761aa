"""Writers: keyed messages, database tables, time series and layouts."""
