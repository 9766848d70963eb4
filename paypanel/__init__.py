"""Payroll panel analytics expressed as Spark DataFrame jobs."""

from paypanel.session import get_session

__all__ = ["get_session"]
