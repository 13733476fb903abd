from fleetlens.plans.model import REPORT_COLUMNS, UsageModel  # noqa: F401
