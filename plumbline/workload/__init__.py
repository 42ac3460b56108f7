"""Every operator as a named query over the test tables."""

from plumbline.workload import modelling, preparation, profiling, testing, whole  # noqa: F401
from plumbline.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
