"""Layered analytics over streams of payment events, built on PySpark."""
