"""corpusloom: corpus analytics as Spark jobs."""
