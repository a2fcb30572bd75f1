"""Training-data operators over text, embedding, web-page and conversation tables.

Nothing else in the library imports this package. Each module holds one operator with its general interface;
``queries`` applies them to the test tables. Heavy per-row work runs in Arrow batches inside Spark tasks; every
grouping, join and count is a Spark job.
"""
