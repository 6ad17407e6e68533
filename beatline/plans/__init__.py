"""Composite questions (lazy plans)."""

from beatline.plans.queries import *  # noqa: F401,F403
