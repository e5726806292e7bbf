"""quern: a document-catalogue and corpus-preparation engine on Spark DataFrames."""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
