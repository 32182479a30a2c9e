"""Mart models, serving queries, layer rebuilds and metric tables."""
