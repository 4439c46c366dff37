"""Connected components, as the library has them."""

from __future__ import annotations

from ..operators.components import connected_components

__all__ = ["connected_components"]
