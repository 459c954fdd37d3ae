"""remitlens: payment variance and recovery prioritisation as Spark DataFrame jobs."""
