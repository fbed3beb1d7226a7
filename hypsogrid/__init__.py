"""Terrain raster analytics as Spark DataFrames."""
