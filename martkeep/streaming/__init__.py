"""Continuous upkeep of the marts."""

from martkeep.streaming.upkeep import MartUpkeep, UpkeepOptions

__all__ = ["MartUpkeep", "UpkeepOptions"]
