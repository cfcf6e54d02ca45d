"""Relational, graph, matching, sampling and metric operators; one function for each."""
