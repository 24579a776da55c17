"""threadloom: analytics over threaded discussion data, written as Spark DataFrame operators."""
