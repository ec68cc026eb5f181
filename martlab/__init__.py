"""Analytics marts, loaders and checks written as PySpark DataFrame plans."""
