from tidemark.plans.retention import RetentionPlan

__all__ = ["RetentionPlan"]
