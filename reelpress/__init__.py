"""Ratings analytics and article processing as PySpark DataFrame operators."""
