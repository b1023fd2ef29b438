"""Parameters of the engine and of a projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from voxmill.sources import stacks


@dataclass(frozen=True)
class EngineConfig:
    voxelsize_um: tuple[float, float, float] = (1.0, 1.0, 1.0)
    max_pixels_per_leaf: int = 120_000_000
    leaf_dim_divisible_by: int = 2
    max_tilechannels_per_job: int = 1800
    nchannels: int = 1
    roi_origin: tuple[float, float, float] = (0.0, 0.0, 0.0)
    roi_size: tuple[float, float, float] = (1.0, 1.0, 1.0)
    include_origins_outside_roi: bool = False
    interpolation: str = "nearest"
    #: a key of ``bricks.REDUCERS``, or a function of the same kind
    downsampling: str | Callable = "first"
    #: (spark, folder) -> pages as in ``stacks.PAGES``, of the tiles' stacks; and (pages, folder), which writes the nodes' stacks
    read_stacks: Callable = stacks.load
    write_stacks: Callable = stacks.save


@dataclass(frozen=True)
class ProjectionConfig:
    #: 1, 2 or 3: along x, y or z
    axis: int = 3
    #: a key of ``projection.PROJECTIONS``, or a function of the same kind
    function: str | Callable = "max"
    signal_channel: int = 0
    reference_channel: int = 1
    signal_levels: tuple[float, float] = (1.0, 65535.0)
    reference_levels: tuple[float, float] = (1.0, 65535.0)
    crop_um: tuple[float, float] = field(default=(float("-inf"), float("inf")))
    output_pixel_sizes_um: tuple[float, ...] = (1, 3, 10, 30)
