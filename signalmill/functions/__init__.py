from signalmill.functions.flags import register_functions, severe_bottleneck
from signalmill.functions.geo import in_bbox, point, point_wkb, point_x, point_y
from signalmill.functions.times import iso_seconds, lag_seconds, parse_instant

__all__ = [
    "in_bbox",
    "iso_seconds",
    "lag_seconds",
    "parse_instant",
    "point",
    "point_wkb",
    "point_x",
    "point_y",
    "register_functions",
    "severe_bottleneck",
]
