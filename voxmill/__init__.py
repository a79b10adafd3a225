"""voxmill: Spark-native analytics over speech segments and their transcripts."""
