"""Benefits-feed analytics as Spark jobs: as-of selection, de-duplication, filings, enrolment files."""
