"""Imports every plan module, so that the registry is complete."""

from tidemark.plans import chats, files, images, learning, profiling, retail, streams, trips
from tidemark.plans.registry import QUERIES

MODULES = (chats, files, images, learning, profiling, retail, streams, trips)

__all__ = ["MODULES", "QUERIES"]
