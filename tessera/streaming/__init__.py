"""Structured Streaming jobs.

``wordcount`` runs the review word count incrementally over a folder to which
review files keep arriving (``readStream`` of the same quoted CSV layout, the
same cleaning and tokenising expressions, a stateful ``groupBy(word)`` whose
state is bounded by the vocabulary).  ``eventtime`` keeps event-time windows
and sessions under a watermark, with late rows as a side output.  The
reference has no streaming operator.
"""

from tessera.streaming.eventtime import EventSessions, EventWindows
from tessera.streaming.wordcount import start_word_count, word_count_stream

__all__ = ["EventSessions", "EventWindows", "start_word_count", "word_count_stream"]
