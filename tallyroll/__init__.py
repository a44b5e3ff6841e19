"""Payroll analytics on Spark: import, hours, review, payslips, export."""

from tallyroll.schemas import Params
from tallyroll.session import build_session

__all__ = ["Params", "build_session"]
