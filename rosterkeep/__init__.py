"""rosterkeep - account lifecycle and storage governance as Spark DataFrame jobs."""

__version__ = "0.1.0"
