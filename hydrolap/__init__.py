"""hydrolap: data quality, cleaning and multidimensional analysis of measurement records on Spark."""
