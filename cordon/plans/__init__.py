"""Warehouse build, quality gate, publish and the named query catalog."""
