"""Intermediate tables in the folder that the cluster shares."""

from quarrylens.sources.storage import shared_folder, written

__all__ = ["shared_folder", "written"]
