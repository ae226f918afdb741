"""granary: a Spark-native engine that turns raw commerce tables into checked, query-ready data."""
