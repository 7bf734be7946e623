"""Trade-abuse analytics expressed as Spark DataFrame and Structured Streaming jobs."""

from tapewarden.config import DetectionConfig

__all__ = ["DetectionConfig"]
