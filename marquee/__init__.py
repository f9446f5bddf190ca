"""Sequence features and audience retrieval over rating histories, as Spark DataFrame plans."""

from marquee.config import SequenceConfig, SkewPolicy

__all__ = ["SequenceConfig", "SkewPolicy"]
