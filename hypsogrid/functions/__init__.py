"""The library's column functions in one place: each takes and gives columns and works in any select."""

from ..operators.boxes import buffered, close, contains, intersection, range_contains, range_intersection, range_union
from ..operators.grid import affine, align_origin, from_tag, inverse_affine, parse_tile_path, phase_distance, ring, snap_window, tile_path, to_tag
from ..operators.lattice import resolution_of_metres, tile_of, window_bounds, window_of_transform, window_transform
from ..operators.polygons import crosses_ray, segment_meets_box
from ..operators.rasters import bounds_of, valid
from ..operators.sampling import lerp2
from ..sources.manifest import epsg_of, pattern_problem
from ..sources.worlds import lonlat_pairs, optional_number, origin, points_problem

__all__ = [
    "affine", "align_origin", "bounds_of", "buffered", "close", "contains", "crosses_ray", "epsg_of", "from_tag", "intersection", "inverse_affine",
    "lerp2", "lonlat_pairs", "optional_number", "origin", "parse_tile_path", "pattern_problem", "phase_distance", "points_problem", "range_contains",
    "range_intersection", "range_union", "resolution_of_metres", "ring", "segment_meets_box", "snap_window", "tile_of", "tile_path", "to_tag", "valid",
    "window_bounds", "window_of_transform", "window_transform",
]
