"""haulscore: fish-community condition scores for seine hauls, as Spark DataFrame operators."""
