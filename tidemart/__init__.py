"""Event and transaction warehouse jobs expressed as Spark DataFrame plans."""
