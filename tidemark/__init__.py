"""Longitudinal measurement over tables and streams, as DataFrame operators for Spark."""
