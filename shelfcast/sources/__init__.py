from .adapter import Sources, load_sources
from .readers import read_sources, read_optional, read_feature_table

__all__ = ["Sources", "load_sources", "read_sources", "read_optional", "read_feature_table"]
