"""Makes this package importable on the executors."""

from portrait.ship import ship  # noqa: F401
