"""starmart: a star-schema sales warehouse written as Spark DataFrame jobs."""
