"""Paths of the hand-written fixtures."""

from __future__ import annotations

import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def fixture_path(name: str) -> str:
    return os.path.join(FIXTURES, name)
