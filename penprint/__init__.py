"""penprint: authorship analytics for text corpora, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
