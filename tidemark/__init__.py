"""Tidemark: data-quality gating and anomaly monitoring of a customer funnel on Spark.

Visits, applications, accounts and transactions move through bronze, silver and
gold tables. Every transform is a ``DataFrame -> DataFrame`` function that works
on batch and streaming input alike.
"""
