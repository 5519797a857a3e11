"""Terminology mining and text-expertise analytics on Apache Spark."""
