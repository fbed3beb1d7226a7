"""Registered queries with their oracle SQL, by survey section."""

from __future__ import annotations

from . import blocks, builds, catalogue, checks, grids, lattice, polygons, rasters, registry, sampling, services, sources, vertical


def all_queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(registry.ORACLES)
