"""refnet: a repository-to-repository reference network built from a code-hosting activity log.

Operators take DataFrames and return a DataFrame and touch no storage. Given a list of hot keys they run no action either;
without one, a balanced join counts its keys first. ``refnet.plans.network`` decides what is kept or written.

Layout
------
``refnet.schema``      event-type constants, StructTypes
``refnet.session``     session defaults and the shared work folder
``refnet.functions``   column expressions (timestamp parsing, timestamp key, safe ratio, case label)
``refnet.sources``     delimited / parquet readers and writers, the log derived from ``events``
``refnet.operators``   normalise, core contributors, references, citations, J and actual I
``refnet.plans``       balanced joins, handed-on tables, the whole run, SQL views and functions
``refnet.llm``         training-data operators; nothing outside uses them
"""

__version__ = "0.2.0"
