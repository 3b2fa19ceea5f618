"""variantloom: variant-to-gene analytics as Spark DataFrame operators."""
