"""Structured Streaming: ``sources`` (broker / files), ``sinks``
(checkpointed writers, archive), ``state`` (keyed state, snapshots, request
answering) and ``jobs`` (deployable queries).
"""
