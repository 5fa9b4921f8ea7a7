"""Rules, evaluation, profiling, standardization, scoring and reports."""
