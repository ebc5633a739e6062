"""siftlane: Spark-native entity intelligence and text-table operators."""
