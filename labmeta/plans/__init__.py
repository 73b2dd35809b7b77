"""End-to-end plans: loading the warehouse, syncing resources, cohort queries."""
