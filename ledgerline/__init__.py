"""Register analytics on Spark: gates, versions, linkage, geography, disclosure and market statistics as DataFrame operators."""
