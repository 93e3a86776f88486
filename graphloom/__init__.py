"""Graphloom: knowledge-graph and text analytics on Spark DataFrames."""
