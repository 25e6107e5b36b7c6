"""Table operators: joins, aggregates, ranking, sets, subqueries, changes, quality."""
