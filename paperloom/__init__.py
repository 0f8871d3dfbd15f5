"""Paperloom: turn raw review and paper records into clean, queryable, model-ready tables on Spark."""
