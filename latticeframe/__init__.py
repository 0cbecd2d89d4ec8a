"""Grid and pipeline-table analytics on Spark."""
