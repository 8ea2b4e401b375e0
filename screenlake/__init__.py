"""Perturbation-screen and text-pair data work on Spark DataFrames."""

__version__ = "0.1.0"
