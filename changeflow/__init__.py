"""changeflow: change-log replication, collections and ageing as Spark DataFrame jobs."""
