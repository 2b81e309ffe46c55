"""quillgraph: link-graph analytics expressed as Spark DataFrame, SQL and Structured Streaming plans."""
