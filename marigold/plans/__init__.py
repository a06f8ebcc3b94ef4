"""The master tables, the summaries and the jobs that read, compute and write them."""
