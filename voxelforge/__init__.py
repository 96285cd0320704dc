"""Structure-map quality engine on Spark: DataFrame operators over long tables."""
