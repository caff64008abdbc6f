"""Disk of finished steps."""

from __future__ import annotations

from encore.storage import freed

__all__ = ["freed"]
