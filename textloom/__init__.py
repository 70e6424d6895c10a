"""textloom: labelled-text preparation, FAQ retrieval and chat-log analytics on Spark."""
