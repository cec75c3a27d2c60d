"""DataFrame operators: windowed counts, top-k, latest version, counters,
retention.  All are lazy ``DataFrame -> DataFrame`` functions."""
