"""Job-board captures to one postings table, as Spark jobs."""
