"""Message delivery and routing on Spark DataFrames.

A topic is a DataFrame of envelopes (topic, partition, offset, key, value).
The sub-packages hold readers (`sources`), column functions (`functions`),
DataFrame operators (`operators`), the queries built from them (`plans`) and
the Structured Streaming runner (`streaming`).
"""
