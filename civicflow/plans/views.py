"""Products registered as temp views and questions asked of them in Spark SQL.

A view is a lazy DataFrame under a name, recomputed (or re-read) on use.  P9-P11 are
views themselves, so a dashboard selects from them by name; further questions are
plain SQL over the registered products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicflow.sources.tables import view

# Question -> SQL over the registered views.
QUESTIONS = {
    "per_capita": """
        select borough_name, complaints_per_100k, rank() over (order by complaints_per_100k desc) as place,
               complaints_per_100k > (select sum(total_complaints) * 100000 / sum(population_2020) from v_requests_per_100k) as above_city
        from v_requests_per_100k""",
    "median_by_category": """
        select m.category, m.median_hours, t.request_types, m.median_hours > (select avg(median_hours) from v_median_response) as slower_than_most
        from v_median_response m join (select category, count(*) as request_types from v_request_type group by category) t using (category)""",
    "monthly_trend": """
        select month, complaints, complaints - lag(complaints) over (order by month) as change,
               pct_resolved - first(pct_resolved) over (order by month) as points_since_start
        from v_monthly_trend""",
    "open_backlog": """
        with waiting as (
          select borough_name, days_since_created, complaint_age_bucket
          from v_fact join v_borough using (borough_sk)
          where is_open and not is_missing_metadata)
        select borough_name, complaint_age_bucket as age, count(*) as waiting, max(days_since_created) as oldest_days
        from waiting group by all""",
    "busiest_day": """
        select borough_name, created_date, requests from (
          select borough_name, created_date, sum(total_complaints) as requests,
                 rank() over (partition by borough_name order by sum(total_complaints) desc, created_date) as place
          from v_daily group by borough_name, created_date)
        where place = 1""",
}


def register(products: dict[str, DataFrame]) -> None:
    """Register each product under ``v_<name>``."""
    for name, df in products.items():
        view(df, f"v_{name}")


def ask(spark: SparkSession, question: str) -> DataFrame:
    return spark.sql(QUESTIONS[question])
