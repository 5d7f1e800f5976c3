"""Gene-order, homolog and reference-set analytics as Spark DataFrame operators."""
