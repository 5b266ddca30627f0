"""Load plans: what to load (spec) and the jobs that do it."""
