"""Tables that an operator keeps between jobs, in the folder that driver and executors share."""

from __future__ import annotations

from namewright.sources.shared import SETTING, drop, keep, shared_dir

__all__ = ["SETTING", "drop", "keep", "shared_dir"]
