"""Whole queries, composed of operators."""

from adstream.plans.ctr import (
    ctr_from_records,
    ctr_left_join,
    ctr_one_pass,
    ctr_smoothed,
)

__all__ = ["ctr_from_records", "ctr_left_join", "ctr_one_pass", "ctr_smoothed"]
