"""bikeflow: Spark-native analytics for dock-based bike-share systems."""
