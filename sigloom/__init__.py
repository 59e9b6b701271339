"""Item-signal data engine: plain ``DataFrame -> DataFrame`` functions on Spark SQL."""
