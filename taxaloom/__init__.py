"""Abundance-data curation as Spark DataFrame operators.

Sub-packages: ``functions`` (Column -> Column), ``operators`` (DataFrame -> DataFrame),
``sources`` (readers and sinks) and ``plans`` (composed jobs and the registered queries).
"""
