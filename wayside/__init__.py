"""Wayside: place point incidents on the linear asset they belong to, as Spark DataFrame jobs."""
