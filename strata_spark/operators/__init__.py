from . import draw_index, geo, layout, sampling, tabulate, validate

__all__ = ["draw_index", "geo", "layout", "sampling", "tabulate", "validate"]
