"""editpulse: edit-stream analytics as Spark DataFrame transformations.

The package turns captured page-edit events (SSE text frames or JSON
messages) into windowed edit counts and answers time-range questions
over those counts.  Every transformation is a function
``DataFrame -> DataFrame`` that runs unchanged in batch and in
Structured Streaming; only sources, sinks and the streaming runner are
aware of the execution mode.
"""

__version__ = "0.1.0"
