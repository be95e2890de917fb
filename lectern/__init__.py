"""Lectern: lecture transcripts to a searchable knowledge base, as Spark jobs."""
