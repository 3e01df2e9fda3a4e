"""Comment moderation analytics as lazy Spark DataFrame operators."""

from tideguard.config import DEFAULTS, LABELS, THRESHOLDS, ModerationConfig

__all__ = ["DEFAULTS", "LABELS", "THRESHOLDS", "ModerationConfig"]
