"""Mobile-app event analytics on Spark: raw vendor logs, daily marts, product reports."""
