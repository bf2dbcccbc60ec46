"""Card-transaction lake on Spark: change capture, marts, quality, monitoring, fraud."""

from txnlake.session import build_session, tune

__all__ = ["build_session", "tune"]
