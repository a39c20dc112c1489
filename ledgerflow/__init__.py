"""ledgerflow: chat payment messages to accounts, as Spark DataFrame jobs."""
__version__ = "0.1.0"
