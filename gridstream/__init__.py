"""gridstream: Spark-native analytics for time-stamped station load telemetry.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a Column
builder) so that Catalyst sees one declarative plan; stateful streaming
operators live in :mod:`gridstream.streaming`.
"""

__version__ = "0.1.0"
