"""Validated bulk loading expressed as Spark DataFrame plans."""

from loadsieve.plans.spec import ColumnMeta, LoadSpec
from loadsieve.session import build_session, shared_dir

__all__ = ["ColumnMeta", "LoadSpec", "build_session", "shared_dir"]
