"""Pipeline plans: staging, marts, exports, measures, quality checks, legacy variants."""
