"""Job composition and plan inspection."""

from sigscore.plans.inspect import check_plan, exchange_count, plan_text  # noqa: F401
from sigscore.plans.job import JobConfig, config_for, cook_hour, run_hour  # noqa: F401
