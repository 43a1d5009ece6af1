"""Retail batch files and event feeds to silver tables and daily figures, on Spark."""
