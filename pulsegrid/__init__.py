"""Patient vital-signs analytics as Spark jobs: prepare, publish, decode, enrich, train, score, monitor."""
