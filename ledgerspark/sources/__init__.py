from ledgerspark.sources.files import load_sources, read_weights_wide, register_views
from ledgerspark.sources.fixtures import fixture_sources, read_table
from ledgerspark.sources.model import Sources

__all__ = ["Sources", "fixture_sources", "load_sources", "read_table", "read_weights_wide",
           "register_views"]
