"""Payment-risk monitoring and customer-commerce reporting on Spark DataFrames."""
