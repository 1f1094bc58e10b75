from feedloom.streaming.incremental import load_available, replace_when_landed
from feedloom.streaming.paged import Loaded, load_paged

__all__ = ["Loaded", "load_available", "load_paged", "replace_when_landed"]
