"""curatrix: a PySpark-native engine for curating archives into audited datasets."""
