"""grantlens: a PySpark-native engine for messy disclosure filings."""
