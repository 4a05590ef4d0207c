"""millrace: batch and streaming data jobs on Spark DataFrames."""

from millrace.session import Tables, Workspace, build_session

__all__ = ["Tables", "Workspace", "build_session"]
