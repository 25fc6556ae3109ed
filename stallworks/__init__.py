"""Batch analytics for marketplace operations, written as Spark DataFrame plans."""

from .params import DateWindow, SourceOffsets

__all__ = ["DateWindow", "SourceOffsets"]
