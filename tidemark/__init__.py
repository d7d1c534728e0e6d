"""Customer-retention analytics as Spark DataFrame operators."""

from tidemark.params import Params
from tidemark.session import build_session, tune
from tidemark.workspace import Workspace

__all__ = ["Params", "Workspace", "build_session", "tune"]
