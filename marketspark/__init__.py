"""Market-trade analytics on Spark: bronze, silver and gold trade layers, marts, checks and serving queries."""

__version__ = "0.1.0"
