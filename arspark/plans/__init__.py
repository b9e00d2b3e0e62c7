"""Marts, measures and monitoring jobs: functions ``(Domain, as_of) -> DataFrame``."""
