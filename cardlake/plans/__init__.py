"""Plans: join strategy helpers, the star model, measures, report queries, serving views, tables, pipeline."""
