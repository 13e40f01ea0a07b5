"""Bronze / silver / gold lake of satellite fire hotspots, as plain PySpark jobs."""
