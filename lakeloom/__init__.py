"""lakeloom: weave a triple knowledge base into a data lake of many small tables, on Spark."""
