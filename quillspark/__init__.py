"""A Spark-native engine for analysing corpora of scripts and turning them into audited datasets."""
