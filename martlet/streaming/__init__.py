"""Streaming: intentionally empty.

The workload this package covers is batch only: there is no event-time window,
watermark or stateful operator to carry over. Every job here is a plain
``DataFrame -> DataFrame`` function, so the stateless ones (projections, filters,
stream-static joins against the dimension views) can be applied to a streaming
DataFrame unchanged should a streaming source be added later.
"""
