"""Operators: ``DataFrame -> DataFrame`` functions for batch and streams.

``overlap`` coverage pairs; ``latest`` latest fix and snapshot; ``asof`` as-of
join, closest object and request answers; ``motion`` motion vectors;
``windows`` sliding windows and retention; ``tracks`` tracks, history path,
map output; ``ingest`` parsing, validation, routing; ``codecs`` messages.
"""
