"""Plans: silver and gold tables, daily metrics, reports, and the batch pipeline."""
