"""DataFrame operators over points, pixels, tiles and polygons."""
