"""Workbooks that queries and tests write before they scan them."""

from __future__ import annotations

from replivote.sources.workbook_sink import file_system, write_workbooks

__all__ = ["file_system", "write_workbooks"]
