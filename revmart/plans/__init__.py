from revmart.plans.jobs import (
    bronze_job,
    gold_job,
    landing_frame,
    landing_job,
    quality_report,
    run_stages,
    silver_job,
)
from revmart.plans.sql import gold_sql, run_on

__all__ = [
    "bronze_job",
    "gold_job",
    "gold_sql",
    "landing_frame",
    "landing_job",
    "quality_report",
    "run_on",
    "run_stages",
    "silver_job",
]
