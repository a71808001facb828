"""Jobs (staged plans) and the registered queries over the driver's test tables."""
