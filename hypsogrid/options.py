"""Options of a build and of a sampler, checked when they are made."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

DATUMS, INTERPOLATIONS = ("egm96", "wgs84-ellipsoid", "bpv"), ("nearest", "bilinear", "cubic")


class OptionError(ValueError):
    """An option that cannot be used."""


def _positive(**values: float) -> None:
    for name, v in values.items():
        if not v > 0:
            raise OptionError(f"{name} must be positive, not {v}")


@dataclass(frozen=True)
class PrepareOptions:
    """What a build needs to know; sizes in pixels, resolutions in metres."""

    resolution: float = 2.0
    tile_px: int = 4096
    block_px: int = 256
    origin_x: float = -1_000_000.0
    origin_y: float = -800_000.0
    datum: str = "wgs84-ellipsoid"
    source_datum: str = "egm96"
    interpolation: str = "bilinear"
    most_request_px: int = 2048
    timeout_s: float = 120.0
    retries: int = 3
    #: Tiles that cannot be used again: replaced, or an error. `rebuild` replaces all.
    overwrite: bool = False
    rebuild: bool = False
    include_rgb: bool = False
    rgb_resolution_m: float = 0.25
    #: Of the geographic lattice: pixels of imagery of a tile's side, and of a pixel of heights.
    wgs_tile_px: int = 8192
    wgs_height_factor: int = 8
    nodata: float = -9999.0
    #: Folders of undulation grids (one folder each, named as the grid) and of the store of replies.
    undulations: str | None = None
    replies: str | None = None
    validate_tiles: bool = True
    plausibility: bool = True
    plausible: tuple[float, float] = (-100.0, 2100.0)

    def __post_init__(self) -> None:
        _positive(rgb_resolution_m=self.rgb_resolution_m, wgs_tile_px=self.wgs_tile_px, wgs_height_factor=self.wgs_height_factor)
        _positive(resolution=self.resolution, tile_px=self.tile_px, block_px=self.block_px, most_request_px=self.most_request_px, timeout_s=self.timeout_s)
        if self.tile_px % self.block_px:
            raise OptionError(f"tile_px {self.tile_px} is not a whole number of blocks of {self.block_px}")
        if self.wgs_tile_px % self.wgs_height_factor:
            raise OptionError(f"wgs_tile_px {self.wgs_tile_px} is not a whole number of pixels of heights, {self.wgs_height_factor} a side")
        if not abs(self.nodata) < float("inf"):
            raise OptionError("nodata must be finite")
        if self.datum not in DATUMS or self.source_datum not in DATUMS:
            raise OptionError(f"datum is one of {', '.join(DATUMS)}")
        if self.interpolation not in INTERPOLATIONS:
            raise OptionError(f"interpolation is one of {', '.join(INTERPOLATIONS)}")
        if self.retries < 0 or not self.plausible[0] < self.plausible[1]:
            raise OptionError("retries must not be negative, and the plausible range not be empty")


def default_dataset() -> str:
    """The dataset that is read if none is named."""
    return os.environ.get("HYPSOGRID_DATASET", os.path.join(os.path.dirname(os.path.abspath(__file__)), "dataset"))


@dataclass(frozen=True)
class SamplerOptions:
    """Parameters of a sampler: its dataset and how a stream of points is read."""

    dataset: str = field(default_factory=default_dataset)
    bytes_per_trigger: int = 256 << 20
    trigger: str = "10 seconds"
    #: How long after its time a point is still taken.
    late: str = "30 minutes"

    def __post_init__(self) -> None:
        _positive(bytes_per_trigger=self.bytes_per_trigger)
