"""A Spark-native engine for statute knowledge graphs: typed property graphs as DataFrames."""
