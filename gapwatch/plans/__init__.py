from gapwatch.plans.profile import profile
from gapwatch.plans.run import completeness_results, run, run_feed
from gapwatch.plans.session import use_utc

__all__ = ["profile", "completeness_results", "run", "run_feed", "use_utc"]
