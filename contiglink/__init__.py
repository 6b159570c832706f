"""contiglink: shared-region and lineage-discordance analytics on Spark DataFrames."""
