"""Spark-native analytics over linked entity tables: resolution, keyed merges, graph closure, facets, scores, diffs and exports."""
