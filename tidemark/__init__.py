"""Entity change data on Spark: version history, time travel, delta export."""
