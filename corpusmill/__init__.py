"""corpusmill: document-corpus preparation, retrieval and evaluation as Spark DataFrame plans."""
