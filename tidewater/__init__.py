"""tidewater: DataFrame operators for cleaning, checking, joining and summarising large tables on Spark."""

from tidewater.session import build_session, materialise, scratch_dir
from tidewater.tables import Tables

__all__ = ["Tables", "build_session", "materialise", "scratch_dir"]
