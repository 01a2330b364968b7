"""All registered queries and their DuckDB oracle SQL."""

from quarry.plans import basket_jobs, model_jobs, neighbour_jobs, sample_jobs, table_jobs, text_jobs

QUERIES = {}
SQL = {}
for _m in (basket_jobs, table_jobs, text_jobs, sample_jobs, neighbour_jobs, model_jobs):
    QUERIES.update(_m.QUERIES)
    SQL.update(_m.SQL)
