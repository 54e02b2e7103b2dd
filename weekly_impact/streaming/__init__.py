"""Incremental refresh of weekly results as shards land, change or go."""

from .funnel_stream import read_weekly_funnel, refresh_weekly_funnel, watch_weekly_funnel

__all__ = ["read_weekly_funnel", "refresh_weekly_funnel", "watch_weekly_funnel"]
