"""tidemark: data quality, feature preparation, model training and drift
monitoring as DataFrame-to-DataFrame Spark jobs."""

__version__ = "0.1.0"
