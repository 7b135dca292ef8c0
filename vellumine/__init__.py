"""vellumine: a PySpark engine for document analytics and hybrid retrieval."""
