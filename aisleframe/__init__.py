"""Retail chain analytics as Spark jobs: checked star schema, promotion baselines, stock-out risk, targets and reports."""
