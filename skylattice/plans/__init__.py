"""Jobs that read, compute and write, and the queries of the driver contract."""
