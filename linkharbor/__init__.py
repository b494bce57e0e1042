"""Backlink analysis over a web-scale domain link graph, as Spark DataFrame plans."""
