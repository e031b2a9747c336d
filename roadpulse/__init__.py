"""Road-speed analytics as Spark DataFrame transformations."""
