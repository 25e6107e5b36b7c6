"""Multi-step plans: running totals that survive hot groups, views, materialized views."""
