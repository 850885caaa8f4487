from tidemark.sinks.extracts import publish_extracts
from tidemark.sinks.files import write_bronze, write_csv, write_quarantine
from tidemark.sinks.versions import Versions

__all__ = ["Versions", "publish_extracts", "write_bronze", "write_csv", "write_quarantine"]
