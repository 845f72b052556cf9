"""Composed plans: rule resolution, the eleven metrics, the five bridging modes."""
