"""Sessions and weekly activity from raw user events, as Spark DataFrame jobs."""
