"""A PySpark-native engine for environmental time series and training-data tables."""
