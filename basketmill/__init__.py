"""Retail data cleaning, modelling, checking and analysis as Spark jobs."""
