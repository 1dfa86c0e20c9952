"""Relational operators: profiling, cleaning, features, statistics, star
schema, scoring, disruption modelling, views and dashboard data sets."""
