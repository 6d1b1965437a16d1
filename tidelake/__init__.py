"""A Spark-native versioned table layer with a training-data toolbox beside it."""
