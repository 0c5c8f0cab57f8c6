"""Curation, audit, publication and matching of a funding catalogue as Spark jobs."""
