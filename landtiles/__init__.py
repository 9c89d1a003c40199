"""Land-use classification of image tiles as Spark DataFrame jobs."""
