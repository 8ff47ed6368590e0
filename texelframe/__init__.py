"""Texture analytics on Spark: textures as tables of samples.

Every operator maps DataFrames to DataFrames over a whole collection of
textures; see the README for the table layouts.
"""
