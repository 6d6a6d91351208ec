"""recolith: Spark-native record linkage."""
