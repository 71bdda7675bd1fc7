"""ledgerloom: a Spark-first engine for auditable contact datasets."""
