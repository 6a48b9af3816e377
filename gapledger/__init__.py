"""gapledger: reconciliation, net-sales and log KPIs as Spark DataFrame jobs."""

__version__ = "0.1.0"
